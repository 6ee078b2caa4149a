"""The pipeline, stage by stage, against plain statements of what each stage does."""

from pyspark.sql import functions as F

import corpus_pipeline as P
from colophon.llm._common import materialise
from test_dedup import plain_contained, plain_lines
from test_near_copies import plain_near


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    extra = spark.createDataFrame([(90001, None, "en", "s", 0), (90002, "12 34", "en", "s", 5), (90003, "", "en", "s", 0)], docs.schema)
    docs = materialise(docs.unionByName(extra), "input")
    names = docs.columns
    seen = {}
    for k, (name, stage) in enumerate(P.STAGES):
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = materialise(stage(spark, docs, small), name)
        seen[name] = before, docs
        if k + 1 < len(P.STAGES):
            assert docs.columns == names
    before, out = seen["language"]
    assert {r["doc_id"] for r in out.collect()} == set(before) - {90001, 90002, 90003}
    before, out = seen["lines"]
    plain = plain_lines(sorted(before.items()))
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(before)
    assert {(r["doc_id"], r["text"]) for r in out.collect()} == {eval(x)[:2] for x in plain}  # noqa: S307
    assert out.where(F.col("n_chars") != F.length("text")).count() == 0
    before, out = seen["near_copies"]
    group, _ = plain_near(sorted(before.items()))
    least = {}
    for g, i in zip(group, sorted(before), strict=True):
        least.setdefault(g, i)
    assert {r["doc_id"] for r in out.collect()} == set(least.values())
    before, out = seen["leaks"]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    leaked = {eval(x)[0] for x in plain_contained(sorted(before.items()), items)}  # noqa: S307
    assert leaked and {r["doc_id"] for r in out.collect()} == set(before) - leaked
    before, out = seen["packing"]
    rows = out.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("d")).collect()
    assert {r["doc_id"] for r in rows} == set(before) and all(r["n"] == r["d"] for r in rows)


def test_run_gives_the_last_stage(spark, small):
    assert P.run(spark, small).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert set(P.queries()) == {"pipeline"} and P.ORACLE_SQL is None


def test_stages_with_clashing_names_and_nothing(spark, small):
    extra = ["rejected", "score", "lang_pred", "n_lines", "n_dropped", "_text", "_id", "_key", "key", "_gone", "_drop", "_lines", "component", "_k", "_row"]
    kind = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` int" for c in extra)
    rows = [(k, f"these are some words of text number {'abcdefgh'[k % 8]} of many in a row, as they come and go {k}", "en" if k else None, "s", 5, *range(len(extra))) for k in range(12)]
    for table in (spark.createDataFrame(rows, kind), spark.createDataFrame([], kind)):
        for name, stage in P.STAGES:
            out = stage(spark, table, small)
            assert name == "packing" or out.columns == table.columns
            got = out.collect()
            assert bool(got) == (not table.isEmpty())


def test_leaks_go_by_row(spark, small):
    item = spark.read.parquet(f"{small}/benchmark.parquet").first()["text"]
    docs = spark.createDataFrame([(1, "some " + item), (1, "another text of the same id"), (None, item)], "doc_id long, text string")
    assert [tuple(r) for r in P.no_leaks(spark, docs, small).collect()] == [(1, "another text of the same id")]
