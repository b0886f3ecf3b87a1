"""HTML to text (SCL-04, UDF-01).

The one per-row Python helper on ingest: an Arrow-batched ``pandas_udf`` using
the standard library's ``html.parser``.  Text nodes are stripped, empty ones
dropped, the rest joined by one space; character references are decoded;
script, style, template contents and comments are skipped.  Whole documents
are processed.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

_SKIP = {"script", "style", "template"}


class _TextCollector(HTMLParser):
    """Text nodes: what lies between two tags, comments or declarations, however many
    pieces the parser reports it in.  A CDATA section is a node of its own."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self._node: list[str] = []
        self._skip_depth = 0

    def end_node(self) -> None:
        text = "".join(self._node).strip()
        if text:
            self.parts.append(text)
        self._node.clear()

    def handle_starttag(self, tag, attrs):
        self.end_node()
        if tag in _SKIP:
            self._skip_depth += 1

    def handle_endtag(self, tag):
        self.end_node()
        if tag in _SKIP and self._skip_depth:
            self._skip_depth -= 1

    def handle_data(self, data):
        if not self._skip_depth:
            self._node.append(data)

    def handle_comment(self, data):
        self.end_node()

    def handle_decl(self, decl):
        self.end_node()

    def handle_pi(self, data):
        self.end_node()

    def unknown_decl(self, data):
        self.end_node()
        if data[:6].upper() == "CDATA[":
            self.handle_data(data[6:])
            self.end_node()


def html_to_text(raw: str | None) -> str | None:
    if raw is None:
        return None
    p = _TextCollector()
    p.feed(raw)
    p.close()
    p.end_node()
    return " ".join(p.parts)


@pandas_udf(T.StringType())
def _html_text_udf(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None or (isinstance(x, float) and pd.isna(x)) else html_to_text(x))


def clean_html(col: Column | str, null_as_empty: bool = False) -> Column:
    """SCL-04.  ``null_as_empty`` gives the API reader's behaviour (NULL -> "")."""
    c = F.col(col) if isinstance(col, str) else col
    out = _html_text_udf(c)
    return F.coalesce(out, F.lit("")) if null_as_empty else out
