import os

import pytest

FOLDER = os.environ.get("LLM_TABLES_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def folder():
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    return FOLDER


@pytest.fixture(scope="session")
def documents(spark, folder):
    """Rows of the documents table as plain tuples (doc_id, text, source)."""
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source").collect()
    return [tuple(r) for r in rows]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make(spark):
    """A documents frame from (doc_id, text) or (doc_id, text, source) rows."""

    def build(rows, extra=()):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        schema = SCHEMA + "".join(f", {name} string" for name in extra)
        return spark.createDataFrame([r + ("x",) * len(extra) for r in full], schema)

    return build
