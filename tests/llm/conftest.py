import duckdb
import pytest

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long, slot string, hits string"


@pytest.fixture
def docs(spark):
    """Builds documents from rows (doc_id, text, ...); extra columns clash with names that results use."""

    def build(rows):
        full = [
            (r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None, None, "x", "y") for r in rows
        ]
        return spark.createDataFrame(full, DOC)

    return build


@pytest.fixture(scope="session")
def con():
    found = duckdb.connect()
    for name in ("documents", "embeddings", "benchmark", "labels", "conversations"):
        found.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return found


@pytest.fixture(scope="session")
def texts(con):
    return dict(con.execute("SELECT doc_id, text FROM documents").fetchall())
