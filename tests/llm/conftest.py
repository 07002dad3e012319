import os

import duckdb
import pytest

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck(data_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(data_dir, t)}.parquet'")
    return con


@pytest.fixture()
def documents(spark):
    """Documents with the usual columns and extra ones whose names the operators use themselves."""
    def make(rows):
        full = [(r + (None,) * 5)[:5] + ("x", 7, "y", 1.0) for r in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long, row string, n int, id string, fp double")

    return make
