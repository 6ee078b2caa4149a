import pytest
from pyspark.sql import functions as F

from colophon.functions import textnorm as T
from colophon.functions import venue_text as V
from colophon.operators import affiliations as A
from colophon.operators import gates


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("name,want", [("2026 IEEE Symposium on X", "IEEE Symposium on X"), ("Interspeech 2026", "Interspeech"), ("ICLR2026", "ICLR"), ("34th ACM Multimedia 2026 (MM '26)", "ACM Multimedia"), ("2026", "2026"), ("", "")])
def test_tidy(spark, name, want):
    assert one(spark, V.tidy(F.col("n")), n=name) == want


def test_venue_from(spark):
    f = lambda j, c: one(spark, V.venue_from(F.col("j"), F.col("c")), j=j, c=c)
    assert f("J. of X", "Accepted to Y") == "J. of X" and f("", "Accepted to ICASSP 2025, 5 pages; code") == "ICASSP 2025, 5 pages"
    assert f("", "5 pages, ACL 2024") == "ACL 2024" and f("", "5 pages") is None


def test_family_and_bucket(spark):
    f = lambda s: one(spark, V.family(F.col("s")), s=s)
    assert [f(x) for x in ("Proc. ICME", "ACM Multimedia", "TACL", "nothing")] == ["icme", "acmmm", "tacl", None]
    b = lambda u, t: one(spark, V.evidence_bucket(F.col("u"), F.col("t")), u=u, t=t)
    assert [b("x", "ieee"), b("https://arxiv.org/a", "journal_ref"), b("https://dl.acm.org", ""), b("", "DBLP page"), b("", "")] == ["ieee", "arxiv_journal_ref", "acm", "dblp", "other"]


def test_search_score_and_quotes(spark):
    s = V.search_score(F.col("n"), T.tokens(F.col("w")), F.col("t"), T.tokens(F.col("t")))
    assert one(spark, s, n="AIR-Bench", w="airbench audio question", t="AIR-Bench: benchmarking audio models") == pytest.approx(0.78)
    assert one(spark, V.quote_of(F.col("n"), F.col("p")), n="AIR-Bench", p="we use  AIR Bench here") == "we use AIR Bench here"
    assert one(spark, V.quote_of(F.col("n"), F.col("p")), n="AIR-Bench", p="fair benchmarks") == ""
    assert one(spark, V.distinctive(F.col("n")), n="Echo") is False and one(spark, V.distinctive(F.col("n")), n="MMAU") is True
    assert one(spark, V.page_hit(F.col("a"), F.col("b"), F.col("p")), a="Deep Audio Tests", b="Other", p="the deep  AUDIO tests!") == 1.0


def test_the_paper_wins(spark):
    occ = spark.createDataFrame([("e", 1, "Meta", "paris", "FR"), ("e", 2, "Meta", None, None), ("e", 3, "Meta", None, "DE"), ("e", 4, "Meta", "Menlo", None), ("e", 5, "Meta", "Nowhere", None), ("e", 6, "New", None, None)], "entry string, ord int, raw string, printed_city string, printed_country string")
    aliases = spark.createDataFrame([("Meta", "meta", "US", "US", "Menlo Park", 37.5, -122.2)], "raw string, inst string, inst_country string, country string, city string, lat double, lon double")
    sites = spark.createDataFrame([("Paris", "FR", 48.9, 2.4)], "city string, country string, lat double, lon double")
    got = {r["ord"]: (r["inst"], r["country"], r["city"], r["lat"], r["placed"]) for r in A.placed(occ, aliases, sites).collect()}
    assert got == {1: ("meta", "FR", "Paris", 48.9, "named"), 2: ("meta", "US", "Menlo Park", 37.5, "default"), 3: ("meta", "DE", None, None, "none"), 4: ("meta", "US", "Menlo Park", 37.5, "named"), 5: ("meta", "US", "Nowhere", 37.5, "default"), 6: (None, None, None, None, "none")}


def test_sites_once_and_one_lead(spark):
    occ = spark.createDataFrame([("e", 1, "a", "DE", "Bonn"), ("e", 2, "a", "DE", "bonn"), ("e", 3, "a", "US", None), ("e", 4, "b", "DE", None)], "entry string, ord int, inst string, country string, city string")
    got = A.with_lead(A.once_per_site(occ), F.lit("a")).orderBy("ord").collect()
    assert [(r["ord"], r["lead"]) for r in got] == [(1, True), (3, False), (4, False)]


def test_registry_grows_by_unknown_venues(spark):
    registry = spark.createDataFrame([("neurips", "NeurIPS", "Neural Information Processing Systems", "ml")], "id string, name string, full string, community string")
    names = spark.createDataFrame([(1, "NeurIPS 2025", "", None), (2, "", "neural information processing systems", None), (3, "Audio Workshop 2025", "", "NeurIPS 2025"), (4, "", "", None)], "id int, venue_name string, venue_full string, parent string")
    got = {r["id"]: (r["venue"], r["community"], r["unregistered"]) for r in A.canonical_venues(names, registry).collect()}
    assert got == {1: ("neurips", "ml", False), 2: ("neurips", "ml", False), 3: ("audio-workshop", "ml", True), 4: (None, "other", True)}


def test_registry_and_literature_gates(spark):
    e = spark.createDataFrame([("A Lab", "A", "US"), ("A Lab", "B", "US"), ("Ind", "Independent", None), ("A FR", "A", "FR")], "raw string, canonical string, country string")
    assert {(r["gate"], r["id"], r["severity"]) for r in A.registry_issues(e, ["independent"]).collect()} == {("canonicalised two ways", "A Lab", "hard"), ("excluded pseudo-organisation", "Ind", "soft"), ("several countries", "A", "soft")}
    papers = spark.createDataFrame([("a", "https://arxiv.org/abs/1", "T", "2024"), ("b", "https://x.org", "T", "2024-05")], "id string, url string, title string, date string")
    notes = spark.createDataFrame([("a", ["x", "y"], ["x", ""], ["x"]), ("z", ["x", "y"], ["x", "y"], ["x", "y"])], "id string, target array<string>, finding array<string>, boundary array<string>")
    got = {(r["gate"], r["id"]) for r in gates.union(A.literature_gates(papers, notes, papers.limit(0).select("id"))).collect()}
    assert got == {("literature: not a primary address", "b"), ("notes: no source", "z"), ("notes: incomplete finding", "a"), ("notes: incomplete boundary", "a")}
