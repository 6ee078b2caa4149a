"""Steps that must not grow faster than their input: what is broadcast, how pairs are met, what a task holds."""

import time

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colophon.functions import venue_text
from colophon.operators import canon, match
from colophon.plans import registry
from colophon.sources import tables


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["alias_gates", "family_agreement"])
def test_growing_sides_are_not_broadcast(spark, small, name):
    assert "Broadcast" not in plan(registry.queries()[name](spark, small))


def test_names_of_parts_spell_no_family(spark, tmp_path):
    """Number 89208, in letters, was "ijcai"; the SQL knows no family of such a name."""
    spark.createDataFrame([(89208,), (289208,)], "p_partkey long").write.parquet(f"{tmp_path}/part.parquet")
    got = {r["id"] for r in registry.queries()["family_agreement"](spark, str(tmp_path)).collect()}
    assert got == {89208}  # 89208 % 6 is 0, of Interspeech; 289208 % 6 is 2, of no family


def test_citation_scores_are_those_of_the_tails(spark, tmp_path):
    rows = [(k, "Die Achiever\nund our model. WE PRESENT a survey") for k in (4, 13, 20)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r["tail"], r["reports_score"], r["n"]) for r in registry.queries()["citation_scores"](spark, str(tmp_path)).collect()}
    assert got == {("medieval", 0, 1), ("nothing", 0, 2)}


def test_copies_meet_once_and_names_alone_make_no_pairs(spark):
    """Texts with the same three names but other titles meet nowhere; copies are one class; a tie goes to the least record."""
    words = "amber basalt cedar delta ember fjord garnet harbor indigo jasper kernel lagoon".split()
    people = ["Ann Aster", "Bob Birch", "Cyd Cedar"]
    a = spark.createDataFrame([(k, " ".join(words[:6]) + "!" * k, people) for k in range(1, 4)], "id long, title string, authors array<string>")
    b = spark.createDataFrame([(k, " ".join(words[6:]), people) for k in range(10, 30)] + [(k, " ".join(words[:7]), people) for k in (42, 41, 43)], "rec long, rec_title string, rec_authors array<string>")
    one = match.prepared(b, "rec_title", "rec_authors", "b_")
    often = one.select(F.explode("b_tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    ours = match._keys(match.prepared(a, "title", "authors", "a_"), "id", "a_", often)
    assert ours.join(match._keys(one.where("rec < 40"), "rec", "b_", often), "k").count() == 0
    assert ours.join(match._keys(one.where("rec > 40"), "rec", "b_", often), "k").count() > 0
    got = {r["id"]: (r["rec"], r["kind"], round(r["score"], 6)) for r in match.best_matches(a, b).collect()}
    assert got == {k: (41, "fuzzy", 1.0) for k in range(1, 4)}


def test_quotes_are_those_of_the_whole_pattern(spark):
    """Of pages of all kinds the same quote as by one pattern, and of a long page without the name without trying it at each place."""
    end, odd = "\u2028", "\U0001f600"
    pages = ["", "the", "The end", "other theory lathe", "lathe " * 30 + "the end", "x" * 89 + " the cat and the dog", "a the b the c" + " d" * 90, "the-the\nthe" + "y" * 200, f"{odd * 100} the {odd * 100}", f"a{end}the cat{end}the"]
    pages += [f"{'the' * k}{end}{'z' * k} THE {'w ' * k}the" for k in (1, 29, 30, 31, 88, 89, 90, 91, 92)] + [f"{'q' * k}the {'r ' * k} the, {'the' * 61}" for k in range(86, 94)] + [None]
    df = spark.createDataFrame([(k, p) for k, p in enumerate(pages)], "id int, page string")
    for name in ("the", "w-the", "c++ the"):
        quoted = name.replace("+", r"\\+").replace("-", "[- ]?")
        whole = F.expr(f"regexp_extract(trim(regexp_replace(coalesce(page, ''), '\\\\s+', ' ')), '(?i)(.{{0,90}}(?<![a-z0-9])(?:{quoted})(?![a-z0-9]).{{0,90}})', 1)")
        assert df.where(whole != venue_text.quote_of(F.lit(name), F.col("page"))).collect() == []
    long = spark.range(1).select(F.repeat(F.lit("Der Abend ist lang. "), 200_000).alias("page"))
    began = time.time()
    assert long.select(venue_text.quote_of(F.lit("the"), F.col("page")).alias("q")).first()["q"] == ""
    assert time.time() - began < 5


def test_values_between_the_bounds_are_not_grouped(spark):
    df = spark.createDataFrame([("b", "m", "score", float(v), "p") for v in range(100)], "benchmark string, model string, metric string, value double, source string")
    assert "<= 10.0" in plan(canon.rescaled_metrics(df)).replace("value", "").split("HashAggregate")[-1]


@pytest.mark.parametrize("name", ["slots_by_group", "disagreements"])
def test_tasks_hold_a_bounded_number_of_rows(spark, small, name):
    assert "REPARTITION_BY_NUM" in plan(registry.queries()[name](spark, small))
    df = tables.by_rows(spark.range(1000), 1000, "id", most=100)
    assert df.rdd.getNumPartitions() == 10


def test_title_matches_are_spread(spark, small):
    assert "REPARTITION_BY_NUM" in plan(registry.queries()["tree_candidates"](spark, small))


def test_parts_of_disagreeing_cells_are_not_broadcast(spark, small):
    assert "SortMergeJoin [l_partkey" in plan(registry.queries()["disagreements"](spark, small))
