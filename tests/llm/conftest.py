import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from odd_rows import CLASH, ROWS  # noqa: E402

from topicloom.session import ship_package  # noqa: E402


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def odd_docs(spark):
    schema = "doc_id long, text string, lang string, " + ", ".join(f"{c} string" for c in CLASH)
    return spark.createDataFrame([(*r, *["clash"] * len(CLASH)) for r in ROWS], schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("1 = 0")
