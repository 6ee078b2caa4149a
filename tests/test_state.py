"""State tables over batches, numbering of wide tables, merged mentions, components and large registries."""

import pytest
from pyspark.sql import Row, Window
from pyspark.sql import functions as F

from colophon.functions import rules, textnorm, unicode, variants
from colophon.operators import graph, pool
from colophon.sources import sinks
from colophon.streaming import state


def entries(spark, rows):
    return spark.createDataFrame(rows, "id long, at long, published string, score double, status string")


def ledger(table):
    return sorted(tuple(r) for r in table.read().collect())


def test_verdicts_stay(spark, tmp_path):
    table = state.StateTable(spark, str(tmp_path / "t"), state.LEDGER, buckets=4)
    assert table.read().count() == 0
    assert table.apply(entries(spark, [(1, 0, "2024-01-01", 20.0, "new"), (2, 0, "2024-01-02", 21.0, "already there"), (3, 0, None, None, "")]), 0, state.ledger)
    assert table.apply(entries(spark, [(1, 0, None, None, "out of scope"), (4, 1, "", 3.0, "newer words"), (4, 2, "2024-02-01", 4.0, "new again")]), 1, state.ledger)
    want = [(1, "2024-01-01", 20.0, "out of scope"), (2, "2024-01-02", 21.0, "already there"), (3, None, None, None), (4, "2024-02-01", 4.0, "newer words")]
    assert ledger(table) == want
    again = entries(spark, [(1, 0, None, None, "another"), (9, 0, None, None, None)])
    assert not table.apply(again, 1, state.ledger) and ledger(table) == want
    assert table.apply(entries(spark, [(1, 0, None, None, "new")]), 2, state.ledger) and ledger(table) == want


def test_a_failed_batch_leaves_the_table(spark, tmp_path):
    table = state.StateTable(spark, str(tmp_path / "t"), "id long, n long", buckets=3)
    rows = lambda ids: spark.createDataFrame([(i, i) for i in ids], "id long, n long")
    assert table.apply(rows(range(20)), 0, state.unseen)
    before = table.manifest()
    broken = F.udf(lambda x: 1 // 0, "long")
    with pytest.raises(Exception, match="ZeroDivisionError"):
        table.apply(rows(range(10, 40)), 1, lambda old, new: state.unseen(old, new).withColumn("n", broken("n")))
    assert table.manifest() == before and table.read().count() == 20
    assert table.apply(rows(range(10, 40)), 1, state.unseen) and table.read().count() == 40


def test_unchanged_buckets_keep_their_files(spark, tmp_path):
    table = state.StateTable(spark, str(tmp_path / "t"), "id long", buckets=5)
    ids = lambda x: spark.createDataFrame([(i,) for i in x], "id long")
    table.apply(ids(range(50)), 0, state.unseen)
    before = table.manifest()["buckets"]
    assert table.apply(ids(range(50)), 1, state.unseen)
    assert table.manifest()["buckets"] == before and table.manifest()["epoch"] == 1
    assert len(list((tmp_path / "t" / "data").iterdir())) == 1
    table.apply(ids([1000]), 2, state.unseen)
    after = table.manifest()["buckets"]
    assert sum(after[b] != before[b] for b in before) == 1 and table.read().count() == 51
    other = state.StateTable(spark, str(tmp_path / "t"), "id long", buckets=5)
    with pytest.raises(RuntimeError, match="another writer"):
        other._switch({"number": 3, "epoch": 9, "buckets": {}})


def test_stream_into_state(spark, tmp_path):
    src, table = str(tmp_path / "src"), state.StateTable(spark, str(tmp_path / "t"), "id long", buckets=2)
    for ids in ([1, 2], [2, 3]):
        spark.createDataFrame([(i,) for i in ids], "id long").coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(src)
    query = stream.writeStream.foreachBatch(lambda b, e: table.apply(b, e, state.unseen) and None).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r["id"] for r in table.read().collect()) == [1, 2, 3] and table.manifest()["epoch"] >= 1


@pytest.mark.parametrize(("parts", "bytes_"), [(64, "64k"), (200, "4m"), (None, "1m")])
def test_batches_of_wide_rows(spark, tmp_path, parts, bytes_):
    """Written places are those of one sorted window, whatever adaptive execution merges."""
    wide = spark.range(40_000).select("id", (F.col("id") * 7919 % 10_007).alias("k"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 4).alias("text"), F.sha2((F.col("id") * 3).cast("string"), 512).alias("more")).repartition(16)
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    shuffles = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", bytes_)
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        order = [F.desc("k"), F.col("id")]
        pool.batches(wide, 7, order, parts).write.parquet(str(tmp_path / "out"))
        index = sinks.write_batches(wide.select("id", "k", "text"), str(tmp_path / "files"), 500, order)
        assert index.agg(F.sum("rows")).first()[0] == spark.read.json(str(tmp_path / "files")).count() == 40_000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
    got = spark.read.parquet(str(tmp_path / "out")).select("id", "batch")
    want = wide.select("id", (F.floor((F.row_number().over(Window.orderBy(*order)) - 1) / 7) + 1).alias("batch"))
    assert got.count() == 40_000 and got.exceptAll(want).isEmpty()


def test_merged_mentions(spark):
    rows = [
        Row(ord=3, key="k", name="B", full_title="T", paper=None, url="", year="2024", category="x", one_line="c", evidence="e2"),
        Row(ord=1, key="k", name=" A ", full_title="", paper="2", url="u", year=None, category="y", one_line="a", evidence=None),
        Row(ord=2, key="k", name="A", full_title="S", paper="1", url=None, year="2024", category="x", one_line=None, evidence="e" * 200),
        Row(ord=4, key="k", name="B", full_title="S", paper="1", url="v", year="2023", category=None, one_line="b", evidence="e1"),
        Row(ord=5, key="l", name="", full_title=None, paper=None, url=None, year=None, category=None, one_line="", evidence=None),
    ]
    df = spark.createDataFrame(rows, "ord long, key string, name string, full_title string, paper string, url string, year string, category string, one_line string, evidence string")
    got = {r["key"]: r.asDict() for r in pool.merged_mentions(df, lines=2, sources=3).collect()}
    assert got["k"] == {"key": "k", "name": "A", "aliases": ["B"], "full_title": "S", "paper": "1", "conflicts": ["2"], "url": "u", "year": "2024", "categories": ["x", "y"], "one_lines": ["a", "c"], "mention_count": 4, "sources": ["", "e1", "e2"]}
    assert got["l"] == {"key": "l", "name": None, "aliases": [], "full_title": None, "paper": None, "conflicts": [], "url": None, "year": None, "categories": [], "one_lines": [], "mention_count": 1, "sources": [""]}


def test_one_key_of_a_million_mentions(spark):
    i, text = F.col("id"), lambda c: c.cast("string")
    df = spark.range(1_000_000).select(i.alias("ord"), F.lit("k").alias("key"), F.concat(F.lit("n"), text(i % 3)).alias("name"), F.lit("t").alias("full_title"), text(i % 7).alias("paper"), F.lit(None).cast("string").alias("url"), text(2020 + i % 2).alias("year"), F.lit("c").alias("category"), text(i).alias("one_line"), text(i).alias("evidence"))
    r = pool.merged_mentions(df).first()
    assert (r["name"], r["aliases"], r["paper"], r["conflicts"]) == ("n0", ["n1", "n2"], "0", ["1", "2", "3", "4", "5", "6"])
    assert r["one_lines"] == ["0", "1", "2", "3"] and r["sources"] == ["0", "1", "10", "100", "1000"] and r["mention_count"] == 1_000_000


def test_reach_in_large_groups(spark):
    """A chain of 10,000 members, two halves, and a group without edges."""
    chain = spark.range(10_000).select(F.lit("chain").alias("group"), "id").union(spark.range(1000).select(F.lit("halves"), "id")).union(spark.range(3).select(F.lit("none"), "id"))
    nodes = chain.select("group", F.col("id").alias("member"))
    edges = chain.where("group <> 'none' and id > 0 and not (group = 'halves' and id = 500)").select("group", F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(F.col("id") - 1).alias("a"), F.when(F.col("id") % 2 == 0, F.col("id") - 1).otherwise(F.col("id")).alias("b"))
    got = sorted(tuple(r) for r in graph.reached(nodes, edges).collect())
    assert got == [("chain", 10_000, 10_000), ("halves", 1000, 500), ("none", 3, 1)]


def test_required_literals():
    assert rules.required(r"\bkeel-?017\b") == ["keel", "017"] and rules.required(r"(?i)gpt-?4o[- ]?mini") == ["gpt", "mini"]
    assert rules.required(r"abc|def") == [] and rules.required(r"abcd?(efg)?\d+x") == ["abc"] and rules.required(r"a.b*c{2}") == []


def test_large_registry_is_the_small_one(spark):
    """The prefilter loses no rule: verdicts are those of one CASE over all rules."""
    registry = [(rf"\bab{k}-?c(d{k})?\b", f"r{k}") for k in range(30)] + [("zed|ab3x", "any"), (r"tail\d{2}$", "tail")]
    names = ["ab3 c", "AB3-C", "ab31c", "ab3c d3", "ab12-cd12", "ab3x", "a zed", "x tail42", "Tail_42", "human ab1c", "n/a", "", None, "asr llm x", "ab7c + whisper", "Whisper + y", "ab2c†"]
    df = spark.createDataFrame([(n,) for n in names], "raw string")
    rows = rules.models_of(df, "raw", rules.registry_table(spark, registry)).collect()
    plain = df.select("raw", rules.model_of(F.col("raw"), [(f"(?i){p}", r) for p, r in registry], drop_start=[f"(?i){p}" for p in rules.DROP_START]).alias("model")).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, plain), key=str) and len({r["model"] for r in rows}) >= 7


def test_normal_forms(spark):
    df = spark.createDataFrame([("Ｆｉｎ",), ("ﬁ",), ("plain",), (None,), ("ﬁ",)], "t string")
    assert sorted((r["n"] or "" for r in unicode.normalised(df, "t", "n").collect())) == ["", "Fin", "fi", "fi", "plain"]
    with pytest.raises(ValueError):
        unicode.normalised(df, "t", "n", "NFX")


def test_variants(spark):
    one = lambda c, **row: spark.createDataFrame([Row(**row)]).select(c.alias("x")).first()["x"]
    doc = F.parse_json(F.col("d"))
    d = '{"a": {"value": "x"}, "b": "y", "c": {"other": 1}, "d": null, "e": [1, "z", {"value": 2}], "f": {"value": [1.50]}}'
    text = [one(variants.as_text(variants.field(doc, k)), d=d) for k in "abcdfg"]
    assert text == ["x", "y", "", "", "[1.5]", ""] and one(variants.as_names(variants.field(doc, "e")), d=d) == ["z"] and one(variants.as_names(variants.field(doc, "b")), d=d) == []
    same = [('{"a": 1, "b": {"c": null, "d": [null]}}', '{"b": {"d": [null]}, "a": 1.0, "x": null}'), ("null", None), ('{"a": null}', "{}"), ('{"k\\":null,": "\\"v\\":null"}', '{"k\\":null,": "\\"v\\":null"}')]
    other = [('{"a": [null, 1]}', '{"a": [1]}'), ('{"a": 1}', '{"a": "1"}'), ('{"a": ":null"}', "{}"), ("{}", None), ('{"a": {}}', "{}")]
    for a, b in same + other:
        assert one(variants.deep_equal(F.col("a"), F.col("b").cast("string")), a=a, b=b or "") == ((a, b) in same) if b else True
    assert one(F.map_entries(variants.merged(F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2)), F.create_map(F.lit("b"), F.lit(3)))), q=1) == [Row(key="a", value=1), Row(key="b", value=3)]
    assert one(textnorm.number(F.col("t")), t="x") is None
