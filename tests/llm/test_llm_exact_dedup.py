import hashlib
import uuid

from reportweave.llm import exact_dedup as ed

SCHEMA = "doc_id bigint, text string, digest string, keep_id int"
ROWS = [
    (1, "a", "x", 1), (2, "a", "x", 1), (3, None, "x", 1), (4, "", "x", 1), (5, "b", "x", 1),
    (7, "long " * 50_000, "x", 1), (6, "long " * 50_000, "x", 1), (5, "b", "x", 1), (None, "b", "x", 1),
    (None, "only", "x", 1), (8, "A", "x", 1),
]


def test_query(against_sql):
    against_sql("op4_exact_dedup")


def test_edges(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    got = {(r.id, r.digest[:6]): r for r in ed.deduplicate(docs, buckets=4).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got[1, sha("a")[:6]].keep_id == 2 and got[1, sha("a")[:6]].group_size == 2
    assert got[3, sha("")[:6]].keep_id == 4 and not got[3, sha("")[:6]].kept
    assert got[6, sha("long " * 50_000)[:6]].keep_id == 7
    assert got[5, sha("b")[:6]].group_size == 3 and got[5, sha("b")[:6]].kept
    assert not got[None, sha("b")[:6]].kept and got[None, sha("only")[:6]].kept
    assert ed.deduplicate(docs, buckets=4).count() == len(ROWS)
    assert ed.deduplicate(docs.where("false"), buckets=4).count() == 0


def test_keep_first_keeps_columns_and_whole_rows(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    kept = ed.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 2, 4, 5, 7, 8]


def test_keep_first_keeps_every_text(spark):
    rows = [(None, "one"), (None, "two"), (None, "two"), (1, "three"), (1, "four"), (1, "four"), (2, "three"), (None, "four")]
    kept = ed.keep_first(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id or -1, r.text) for r in kept) == [(-1, "one"), (-1, "two"), (1, "four"), (2, "three")]


def test_index_takes_deliveries(spark):
    index = ed.DigestIndex(spark, f"index_{uuid.uuid4().hex}", 4)
    day = lambda rows: ed.digests_of(spark.createDataFrame(rows, "doc_id bigint, text string"))
    index.deliver(day([(1, "a"), (2, "a"), (3, "b")]))
    index.deliver(day([(9, "a"), (4, "c"), (5, "c")]))
    index.deliver(day([(9, "a"), (4, "c"), (5, "c")]))  # once more, as after a failure
    assert sorted(r.keep_id for r in index.read().collect()) == [2, 3, 5]
    plan = day([(1, "z")]).join(index.read().hint("merge"), "digest", "left_anti")
    text = plan._jdf.queryExecution().toString()
    assert "SortMergeJoin" in text and "Bucketed: true" in text
    index.drop()


def test_no_python_in_plan(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    plan = ed.deduplicate(docs, buckets=4)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
