import pytest
from pyspark.sql import functions as F

from colophon.functions import geo as G
from colophon.operators import aliases as A
from colophon.operators import canon, corrections, gates, geo, graph, pool, stats, venues
from colophon.plans import registry as plans
from colophon.sources import parsers as P
from colophon.sources import sinks
from colophon.streaming import crawl

CELL = "ord int, benchmark string, model string, metric string, kind string, value string, source string, source_url string, note string"


def observations(spark, changes=()):
    rows = []
    for k in range(3):
        v = str(round(12.3 * (k + 1), 1))
        rows.append([k, "b", f"model-{k}", "Acc.", "number", v, "s1", "https://arxiv.org/abs/2501.00001", None])
        rows.append([3 + k, "b", f"model-{k}", "Accuracy", "number", v, "s2", "https://arxiv.org/abs/2501.00002", None])
    for at, col, v in changes:
        rows[at][col] = v
    df = spark.createDataFrame([tuple(r) for r in rows], CELL)
    return df.withColumn("fp", A.fingerprint(*[F.col(c) for c in ("benchmark", "model", "metric", "kind", "value", "source", "source_url", "note")]))


def registry(spark, cells, paper2="2501.00002", evidence2=None, urls2=None):
    fp = {r["ord"]: r["fp"] for r in cells.collect()}
    member = lambda metric, paper, ords, ev=None, urls=None: (metric, paper, "Table 1", ev or f"https://arxiv.org/abs/{paper}", urls or [f"https://arxiv.org/abs/{paper}"], [fp[o] for o in ords])
    members = [member("Acc.", "2501.00001", [0, 1, 2]), member("Accuracy", paper2, [3, 4, 5], evidence2, urls2)]
    kind = "id string, benchmark string, label string, definition string, members array<struct<metric string, paper string, locator string, evidence_url string, source_urls array<string>, cell_ids array<string>>>"
    return spark.createDataFrame([("approved", "b", "Accuracy", "share right", members)], kind)


def faults(groups, cells):
    return {r["gate"] for r in A.registry_violations(groups, cells).collect()}


def test_alias_group_merges(spark):
    cells = observations(spark)
    groups = registry(spark, cells)
    assert faults(groups, cells) == set()
    assigned = groups.select(F.explode("members").alias("m")).select(F.explode("m.cell_ids").alias("fp"), F.lit("approved").alias("group"))
    index = {(r["key"], r["model"]): r["cells"] for r in A.metric_index(cells, assigned).collect()}
    assert index == {("alias:approved", f"model-{k}"): [k, 3 + k] for k in range(3)}
    # a new model isn't absorbed, and every cell is there once
    more = cells.unionByName(observations(spark, [(0, 2, "new")]).where("model = 'new'").withColumn("ord", F.lit(6)))
    index = {(r["key"], r["model"]): r["cells"] for r in A.metric_index(more, assigned).collect()}
    assert index[("raw:Acc.", "new")] == [6] and sorted(c for x in index.values() for c in x) == list(range(7))


def test_alias_gates(spark):
    good = observations(spark)
    assert "stale reviewed observation" in faults(registry(spark, good), observations(spark, [(0, 5, "99")]))
    assert "stale reviewed observation" in faults(registry(spark, good), observations(spark, [(0, 8, "note")]))
    bounds = observations(spark, [(k, 5, v) for k, v in zip(range(6), ("0", "0", "1", "1", "100", "100"), strict=True)])
    assert "insufficient cross-paper matching evidence" in faults(registry(spark, bounds), bounds)
    same = observations(spark, [(k, 7, "https://arxiv.org/abs/2501.00001v2") for k in (1, 3, 5)])
    assert "cross-paper evidence required" in faults(registry(spark, same, "2501.00001", urls2=["https://arxiv.org/abs/2501.00001v2"]), same)
    assert "missing source evidence" in faults(registry(spark, good, evidence2="https://arxiv.org/abs/2501.99999"), good)
    assert "paper identity mismatch" in faults(registry(spark, good, urls2=["https://example.org/x"]), good)
    odd = observations(spark, [(1, 5, "20")])
    assert "contradictory model values" in faults(registry(spark, odd), odd)
    twice = registry(spark, good).unionByName(registry(spark, good).withColumn("id", F.lit("other")))
    assert "assigned more than once" in faults(twice, good)


def test_fingerprint_keeps_types_apart(spark):
    row = spark.sql("""SELECT parse_json('0.8') AS a, parse_json('"0.8"') AS b, parse_json('12.0') AS c, parse_json('"12.3 ± 0.2"') AS d, parse_json('0') AS e""")
    got = row.select(*[F.struct(*A.variant_kind(F.col(c))).alias(c) for c in "abcde"]).first()
    assert [tuple(x) for x in got] == [("number", "0.8"), ("string", "0.8"), ("number", "12"), ("string", "12.3 ± 0.2"), ("number", "0")]


def test_labels_of_unreviewed_options(spark):
    df = spark.createDataFrame([("b", "alias:x", "Acc", True), ("b", "raw:Acc", "Acc", False), ("c", "raw:Acc", "Acc", False)], "benchmark string, key string, label string, reviewed boolean")
    assert {(r["benchmark"], r["key"]): r["label"] for r in A.labels(df).collect()} == {("b", "alias:x"): "Acc", ("b", "raw:Acc"): "Acc · other sources", ("c", "raw:Acc"): "Acc"}


REC, PATCH = "id string, fields map<string,string>", "ord long, id string, before map<string,string>, after map<string,string>"


def test_corrections_are_idempotent_and_atomic(spark):
    records = spark.createDataFrame([("a", {"status": "published", "new_field": "1"}), ("campus", {"n": "1"})], REC)
    patches = spark.createDataFrame([(1, "a", {"status": "published"}, {"status": "preprint"}), (2, "campus", {"n": "1"}, None), (3, "institute", None, {"n": "2"})], PATCH)
    once = corrections.apply(records, patches)
    assert {r["id"]: r["fields"] for r in once.collect()} == {"a": {"status": "preprint", "new_field": "1"}, "institute": {"n": "2"}}
    assert sorted(map(str, corrections.apply(once, patches).collect())) == sorted(map(str, once.collect()))
    assert corrections.diverged(once, patches).count() == 0
    assert {r["id"] for r in corrections.diverged(records, patches).collect()} == {"a", "campus", "institute"}
    clash = patches.unionByName(spark.createDataFrame([(4, "a", {"status": "unclear"}, {"status": "x"})], PATCH))
    with pytest.raises(gates.GateError, match="patch 4"):
        corrections.apply(records, clash)


def test_patches_of_one_record_fold_in_order(spark):
    records = spark.createDataFrame([("a", {"s": "1"})], REC)
    patches = spark.createDataFrame([(2, "a", {"s": "2"}, {"s": "3"}), (1, "a", {"s": "1"}, {"s": "2"})], PATCH)
    assert corrections.apply(records, patches).first()["fields"] == {"s": "3"}


def test_scale_guard_needs_another_source(spark):
    rows = [("b", "m", "score", 4.78, "p1"), ("b", "m", "score", 95.6, "p2"), ("b", "k", "err", 4.5, "p1"), ("b", "k", "err", 60.0, "p1"), ("b", "m", "acc %", 4.0, "p1"), ("b", "m", "acc %", 90.0, "p2")]
    df = spark.createDataFrame(rows, "benchmark string, model string, metric string, value double, source string")
    assert [tuple(r) for r in canon.rescaled_metrics(df).collect()] == [("b", "score")]
    assert {r["metric"] for r in canon.scale_guard(df, df).collect()} == {"score [0-10 scale]", "score [0-100 scale]", "err", "acc %"}


def test_dedup_is_independent_of_partitioning(spark):
    rows = [("b", "m", "x", float(k), k % 3 == 0, k) for k in range(1, 30)]
    df = spark.createDataFrame(rows, "benchmark string, model string, metric string, value double, own boolean, ord int")
    for n in (1, 7):
        assert canon.dedup_authority(df.repartition(n), ["ord"]).first()["value"] == 3.0


def test_benchmark_index_first_wins(spark):
    df = spark.createDataFrame([(1, "air-bench", "AIR-Bench", ["AIR"]), (2, "air", "Air", None)], "ord int, id string, name string, aka array<string>")
    assert {r["key"]: r["id"] for r in canon.benchmark_index(df).collect()} == {"airbench": "air-bench", "air": "air-bench"}


def test_multi_country_team(spark):
    occ = spark.createDataFrame([("e", "2025-01", "i", "academia", c, "Unknown", False) for c in ("DE", "US")], "entry string, date string, inst string, type string, country string, region string, lead boolean")
    assert {r["country"]: (r["entries"], r["leads"]) for r in geo.countries(occ).collect()} == {"DE": (1, 0), "US": (1, 0)}
    assert tuple(geo.institutions(occ).first())[1:] == (1, 0, 2)


def test_greedy_sites(spark):
    df = spark.createDataFrame([("i", 10.0, 10.0, 5), ("i", 10.2, 10.2, 1), ("i", 10.4, 10.4, 2), ("i", 50.0, 8.0, 1)], "inst string, lat double, lon double, weight int")
    got = sorted((r["lat"], r["weight"]) for r in geo.merged_sites(df, ["inst"]).collect())
    assert got == [(10.0, 6), (10.4, 2), (50.0, 1)]


def test_topology_decode_and_unwrap(spark):
    arcs = spark.createDataFrame([(0, [[10, 20], [1, 2], [-3, 0]])], "arc int, deltas array<array<long>>")
    got = [(r["lon"], r["lat"]) for r in G.decode_arcs(arcs, (0.5, 1.0), (-1.0, 0.0)).orderBy("pos").collect()]
    assert got == [(4.0, 20.0), (4.5, 22.0), (3.0, 22.0)]
    ring = spark.createDataFrame([(0, k, x) for k, x in enumerate((170.0, 179.0, -179.0, -170.0, 175.0))], "ring int, pos int, lon double")
    assert [r["lon"] for r in G.unwrap(ring).orderBy("pos").collect()] == [170.0, 179.0, 181.0, 190.0, 175.0]


def test_chains_and_cycles(spark):
    nodes = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", None), ("x", "y"), ("y", "x"), ("s", "s"), ("q", "gone")], "id string, into string")
    got = {r["id"]: (r["target"], r["cyclic"]) for r in graph.resolve_chains(nodes).collect()}
    assert got["a"] == ("c", False) and got["c"] == ("c", False) and got["s"] == ("s", False) and got["q"] == ("gone", False)
    assert got["x"][1] and got["y"][1]


def test_gates_raise_before_writing(spark, tmp_path):
    df = spark.createDataFrame([("ok-1", "n"), ("Bad Id", ""), ("ok-1", "m")], "id string, name string")
    v = gates.union(gates.registry_gates(df, "model", ["name"]))
    with pytest.raises(gates.GateError, match="duplicate id"):
        sinks.publish({"models": df}, v, str(tmp_path / "out"), report=str(tmp_path / "report"))
    assert not (tmp_path / "out").exists() and (tmp_path / "report").exists()
    sinks.publish({"models": df}, v.limit(0), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out/models")).count() == 3


def test_template_and_payload(spark):
    assert sinks.fill_template("a{X}b", "{X}", r"\1<") == r"a\1<b"
    with pytest.raises(gates.GateError):
        sinks.fill_template("ab", "{X}", "")
    df = spark.createDataFrame([("</script>",)], "x string")
    assert df.select(sinks.payload(df).alias("p")).first()["p"] == '{"x":"\\u003c/script>"}'


def test_html_keeps_tables(spark):
    html = "<h1>T</h1><script>x<p></script><table><tr><th>A</th><td>1 &amp; 2</td></tr></table>"
    got = spark.createDataFrame([(html,)], "h string").select(P.flatten_html(F.col("h")).alias("t")).first()["t"]
    assert got == "T\n[TABLE]\nROW: | A | 1 & 2\n[/TABLE]"


def test_parsers(spark, tmp_path):
    feed = """<feed xmlns="http://www.w3.org/2005/Atom" xmlns:arxiv="x"><entry><id>http://arxiv.org/abs/2501.00001v2</id><title>A
      B</title><summary>s</summary><published>2025-01-01</published><author><name>N M</name></author><arxiv:primary_category term="cs.CL"/></entry></feed>"""
    r = P.atom_entries(spark.createDataFrame([(feed,)], "value string")).first()
    assert (r["id"], r["version"], r["title"], r["authors"], r["primary_category"]) == ("2501.00001", 2, "A B", ["N M"], "cs.CL")
    (tmp_path / "x.bib").write_text('@inproceedings{k1,\n title = {A {B}\n  C},\n author = "X and Y",\n year = 2024\n}\n@article{k2,\n title={Z}\n}\n')
    got = {r["key"]: r["fields"] for r in P.bibtex(spark, str(tmp_path / "x.bib")).collect()}
    assert got["k1"]["title"] == "A {B} C" and got["k1"]["author"] == "X and Y" and got["k1"]["year"] == "2024" and got["k2"] == {"title": "Z"}


def test_json_sources(spark, tmp_path):
    from colophon.sources import json_sources as J

    (tmp_path / "d.json").write_text('{"entries": [{"id": "a"}, {"id": "b"}]}')
    assert [(r["_ord"], r["id"]) for r in J.document(spark, str(tmp_path / "d.json"), "id STRING").collect()] == [(0, "a"), (1, "b")]
    assert J.optional(spark, str(tmp_path / "none.json"), "id STRING").count() == 0
    (tmp_path / "l.jsonl").write_text('{"id": "a"}\n\nbad\n{"x": 1}\n{"id": "b"}\n')
    assert sorted(r["id"] for r in J.lines(spark, str(tmp_path / "l.jsonl"), "id STRING").collect()) == ["a", "b"]
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        J.lines(spark, str(tmp_path / "l.jsonl"), "id STRING", strict=True).collect()
    (tmp_path / "f").mkdir()
    (tmp_path / "f/1.json").write_text('[{"id": "a", "v": "1"}, {"id": "b", "v": "1"}]')
    (tmp_path / "f/2.json").write_text('{"records": [{"id": "a", "v": "2"}]}')
    (tmp_path / "f/3.json").write_text("not json")
    assert {r["id"]: r["v"] for r in J.folder(spark, str(tmp_path / "f"), "id STRING, v STRING").collect()} == {"a": "2", "b": "1"}
    (tmp_path / "m.json").write_text('{"venues": {"x": {"status": "published"}}}')
    assert [tuple(r) for r in J.keyed_map(spark, str(tmp_path / "m.json"), "status STRING", "venues").collect()] == [("x", "published")]


def test_feed_keeps_newest_first(spark):
    fresh = spark.createDataFrame([("n1", "2025-02", 20), ("n2", "2025-01", 30), ("old", "2025-01", 20)], "id string, published string, score int")
    old = spark.createDataFrame([("old", "2024", 50, 0), ("older", "2023", 60, 1)], "id string, published string, score int, place long")
    assert [r["id"] for r in pool.feed(fresh, old, 3).collect()] == ["n2", "old", "n1"]


def test_batches_over_partitions(spark):
    df = spark.range(25).withColumn("k", (F.col("id") * 7) % 25)
    got = {r["id"]: r["batch"] for r in pool.batches(df, 10, ["k"], 5).collect()}
    assert all(b == (i * 7 % 25) // 10 + 1 for i, b in got.items())


def test_cascade_falls_through_empty_claims(spark):
    e = spark.createDataFrame([(1,), (2,)], "id int")
    a = spark.createDataFrame([(1, None, "2024")], "id int, venue string, year string")
    b = spark.createDataFrame([(1, "X", "2023")], "id int, venue string, year string")
    assert {r["id"]: (r["source"], r["venue"]) for r in venues.cascade(e, [("a", a), ("b", b)]).collect()} == {1: ("b", "X"), 2: ("preprint", None)}


def test_audit_and_verdict(spark):
    v = spark.createDataFrame([("a", "preprint", "X 24", "2024", "2024", "Accepted at X", None), ("b", "published", "X24", "2020", "2024", "", "ftp://x"), ("c", "preprint", "Y", "2024", "2024", "Accepted? submitted to Y", None)], "id string, status string, display string, year string, preprint_year string, comment string, url string")
    got = {(r["gate"], r["id"], r["severity"]) for r in gates.audit(v, 2025).collect()}
    assert got == {("missed publication", "a", "HIGH"), ("unusable url", "b", "MED"), ("year before preprint", "b", "HIGH"), ("near-duplicate display", "X 24", "LOW")}


def test_seen_set_across_batches(spark, tmp_path):
    write = crawl.append_unseen(spark, str(tmp_path / "seen"))
    for epoch, ids in enumerate(([1, 2, 2], [2, 3])):
        write(spark.createDataFrame([(i,) for i in ids], "id long"), epoch)
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "seen")).collect()) == [1, 2, 3]


def test_outcomes(spark):
    rows = [(True, None, None, False), (False, None, "new today", False), (False, None, None, True), (False, "Already there", "x", False), (False, "no", "newer", True)]
    df = spark.createDataFrame(rows, "k boolean, v string, s string, f boolean")
    got = [r["o"] for r in df.select(crawl.outcome(F.col("k"), F.col("v"), F.col("s"), F.col("f")).alias("o")).collect()]
    assert got == ["admitted", "under review", "under review", "already catalogued", "not admitted"]


def test_all_observations_that_disagree_are_shown(spark):
    """The values between the least and the largest too, equal ones of two sources, and a missing one; cells of one value are none."""
    seen = [("MMAU", "omni", v, s) for s, v in enumerate([53.92, 59.76, 68.9, 70.6, 59.76, None])]
    seen += [(None, "omni", 1.0, 6), (None, "omni", 2.0, 7), ("MMAU", "other", 3.0, 8), ("MMAU", "other", 3.0, 9), ("MMAU", "third", 4.0, 10), ("MMAU", "third", None, 11), ("MMAU", "blank", None, 12)]
    got = stats.disagreements(spark.createDataFrame([(b, m, "acc", v, s) for b, m, v, s in seen], "benchmark string, model string, metric string, value double, source int"))
    rows = sorted((r["source"], r["value"], r["n"], r["n_values"], r["low"], r["high"]) for r in got.collect())
    assert rows == [(s, v, 6, 4, 53.92, 70.6) for _, _, v, s in seen[:6]] + [(6, 1.0, 2, 2, 1.0, 2.0), (7, 2.0, 2, 2, 1.0, 2.0)]


def test_result_of_disagreements_has_all_their_observations(spark, tmp_path):
    """Lines of two brands through the query: of the cell with values 1, 2, 3 and 2 all four lines, each with its source."""
    spark.createDataFrame([(1, "b1"), (2, "b2")], "p_partkey long, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(1, "s1")], "s_suppkey long, s_name string").write.parquet(f"{tmp_path}/supplier.parquet")
    lines = [(k, p, 1, 1, q, 0.0, 0.0, 0.0, "A", "F") for k, (p, q) in enumerate([(1, 1.0), (1, 2.0), (1, 3.0), (1, 2.0), (2, 5.0), (2, 5.0)])]
    kind = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"
    spark.createDataFrame(lines, kind).withColumn("l_shipdate", F.lit("1995-01-01").cast("timestamp")).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = plans.queries()["disagreements"](spark, str(tmp_path)).collect()
    assert sorted((r["source"], r["value"], r["line"], r["n"], r["n_values"], r["low"], r["high"]) for r in got) == [(k, v, 1, 4, 3, 1.0, 3.0) for k, v in enumerate([1.0, 2.0, 3.0, 2.0])]
