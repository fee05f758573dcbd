"""Small tables with every awkward case: nulls, empty and long texts, repeats, clashing columns."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from plain import CLASH, ROWS  # noqa: E402


@pytest.fixture(scope="session")
def odd_docs(spark):
    extra = (None, 1, "p", None, "t", "d", None, "l", "h")
    return spark.createDataFrame(
        [(*r, *extra) for r in ROWS], f"doc_id long, text string, lang string, {CLASH}"
    ).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
