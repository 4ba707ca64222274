import os

import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def against_sql(spark):
    """Compares a registered query with its SQL on the small tables."""
    import duckdb

    from reportweave.llm.registry import CORPUS_QUERIES, CORPUS_SQL

    def check(name: str, folder: str = SMALL) -> None:
        db = duckdb.connect()
        for file in os.listdir(folder):
            db.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{folder}/{file}'")
        got = CORPUS_QUERIES[name](spark, folder)
        names = sorted(got.columns)
        rows = sorted(map(repr, (tuple(r[c] for c in names) for r in got.collect())))
        wanted = db.sql(CORPUS_SQL[name])
        assert sorted(wanted.columns) == names
        order = [wanted.columns.index(c) for c in names]
        assert rows == sorted(repr(tuple(r[i] for i in order)) for r in wanted.fetchall())

    return check
