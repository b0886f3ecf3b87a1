LONG = "word " * 30_000 + "x" * 50_000
#: Nulls, empty and blank texts, a very long one, ties, repeated rows, a shared and a null id.
ROWS = [
    (1, "Alpha beta gamma delta epsilon zeta.\nSecond line here", "en"),
    (1, "Alpha beta gamma delta epsilon zeta.\nSecond line here", "en"),
    (2, "Alpha beta gamma delta epsilon zeta.\nSecond line here", None),
    (2, "another text with the same id", "en"),
    (3, None, None),
    (4, "", "en"),
    (5, "  \n\t ", "fr"),
    (None, "a text without an id", "en"),
    (6, LONG, "en"),
    (7, LONG, "en"),
    (8, "ñ é 漢字   \U0001f600 İ", "de"),
    (9, "two words", "en"),
    (10, "two words", "en"),
]
CLASH = ("shard", "slot", "key", "name", "pos", "line", "n_lines", "spans", "words", "score", "mask", "tokens", "host", "block", "_m", "_kept", "_d", "size")
