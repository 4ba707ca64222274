"""Compares a registered query with its SQL on a folder of tables."""

import os

import duckdb

from reportweave.plans.checks import checks
from reportweave.plans.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def compare(spark, name, folder=SMALL):
    db = duckdb.connect()
    for file in os.listdir(folder):
        db.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{folder}/{file}'")
    got = QUERIES[name](spark, folder)
    names = sorted(got.columns)
    rows = sorted(repr(tuple(r[c] for c in names)) for r in got.collect())
    wanted = db.sql(checks()[name])
    assert sorted(wanted.columns) == names
    order = [wanted.columns.index(c) for c in names]
    assert rows == sorted(repr(tuple(r[i] for i in order)) for r in wanted.fetchall())
    assert rows
