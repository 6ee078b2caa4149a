"""Repeated lines by a log-template tree of fixed depth.

A line is parsed by its number of tokens and its leading tokens to a leaf; tokens with digits are variable fields. A leaf with
different lines gets its templates in rounds. In each round, each position of a group of lines (at first the leaf) is a constant
if more than half of the group's distinct lines have the same token there; lines that agree with the constants in enough positions
share a template and leave. What is left is split by its tokens at the position of the most frequent token that isn't a constant,
so that unrelated lines of the leaf part, and goes to the next round; a line that ends alone is a template of its own. Templates
that occur in several documents are dropped, but for the document with the least id.

Lines are read once. Their rows carry hashes of 128 bits; the text of a line is read again only where its leaf has different
lines. What is dropped comes back to its text as line positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.llm._common import SPACES, discard, materialise, small

#: Leading tokens of a leaf, share of positions that must agree.
DEPTH, ALIKE = 3, 0.8
#: Whether a span of documents (least id, greatest, whether a null id is among them) has several.
MANY = "(first <> last or (first is not null and nulls))"


def _let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.transform(F.array(value), body)[0]


def _tokens(m: Column) -> Column:
    return F.octet_length(m) - F.octet_length(F.replace(m, F.lit(" "), F.lit(""))) + 1


def _may_differ(n: Column, alike: float) -> Column:
    """Whether any of n tokens may differ."""
    return F.ceil(n * F.lit(alike) - 1e-9) < n


def masked(line: Column, alike: float = ALIKE) -> Column:
    """A line with single spaces and, if any of its tokens may differ, its variable fields (tokens with a digit) replaced."""
    squeezed = F.trim(F.regexp_replace(line, r"[\s]+", " "))
    return F.when(_may_differ(_tokens(squeezed), alike), F.regexp_replace(squeezed, r"(?<![^ ])[^ \d]*+\d[^ ]*+", "<*>")).otherwise(squeezed)


def _masked(line: Column, alike: float) -> Column:
    """`masked`, where there is anything to mask or squeeze."""
    odd = line.rlike("[0-9]") | line.rlike(r"[\t-\r]") | F.contains(line, F.lit("  ")) | line.startswith(" ") | line.endswith(" ")
    return F.when(odd, masked(line, alike)).otherwise(line)


def _lines(docs: DataFrame, depth: int, alike: float) -> DataFrame:
    """A row for each line that isn't empty: doc_id, k (a hash of its text), pos, hashes of the line and of its leaf, n tokens, m."""
    texts = docs.select("doc_id", F.xxhash64("text").alias("k"), F.split("text", "\n", -1).alias("lines"))  # once for each text
    lines = texts.select("doc_id", "k", F.posexplode("lines").alias("pos", "line"))
    lines = lines.where(F.trim(F.col("line"), F.lit("".join(SPACES))) != "")
    lines = lines.select("doc_id", "k", "pos", _masked(F.col("line"), alike).alias("m"))
    lines = lines.withColumn("n", _tokens(F.col("m"))).withColumn("head", F.substring_index("m", " ", depth))
    pair = lambda *x: (F.xxhash64(*x), F.xxhash64(F.lit(7), *x))
    (l1, l2), (g1, g2) = pair("m"), pair("n", "head")
    return lines.select("doc_id", "k", "pos", l1.alias("l1"), l2.alias("l2"), g1.alias("g1"), g2.alias("g2"), "n", "m")


def _span() -> list[Column]:
    return [F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.max(F.col("doc_id").isNull()).alias("nulls")]


def _spans() -> list[Column]:
    return [F.min("first").alias("first"), F.max("last").alias("last"), F.max("nulls").alias("nulls")]


def _templates(lines: DataFrame, alike: float) -> DataFrame:
    """l1, l2, t1, t2 (the template) of the distinct lines (l1, l2, g1, g2, w: hashes of tokens with their positions) that have a template in their group."""
    out, rest, turn = None, lines, 0
    while True:
        # groups of several lines; after the first round most are alone
        sizes = materialise(rest.groupBy("g1", "g2").agg(F.count("*").alias("lines")).where("lines > 1"), f"sizes{turn}")
        if sizes.isEmpty():
            return out if out is not None else rest.select("l1", "l2", F.lit(0).cast("long").alias("t1"), F.lit(0).cast("long").alias("t2")).limit(0)
        rest = rest.join(small(sizes), ["g1", "g2"])
        counts = rest.select("g1", "g2", "lines", F.posexplode("w").alias("pos", "token")).groupBy("g1", "g2", "lines", "pos", "token").agg(F.count("*").alias("c"))
        # of each group: its constants, and the position that splits it (packed after the count, the least of equals)
        usual = F.collect_list(F.when(F.col("c") * 2 > F.col("lines"), F.col("token")))
        split = F.max(F.when(F.col("c") * 2 <= F.col("lines"), F.shiftleft("c", 31) + F.lit(2**31 - 1) - F.col("pos")))
        groups = counts.groupBy("g1", "g2").agg(usual.alias("usual"), (F.lit(2**31 - 1) - split.bitwiseAND(F.lit(2**31 - 1))).cast("int").alias("at"))
        groups = materialise(groups, f"groups{turn}")
        found = rest.join(groups, ["g1", "g2"])
        same = F.size(F.array_intersect("w", "usual"))
        found = materialise(found.select("l1", "l2", "g1", "g2", "w", "at", (same >= F.size("w") * F.lit(alike) - 1e-9).alias("joins")), f"round{turn}")
        joined = found.where("joins").select("l1", "l2", F.xxhash64("g1", "g2").alias("t1"), F.xxhash64(F.lit(7), "g1", "g2").alias("t2"))
        out = joined if out is None else out.unionByName(joined)
        side = ["g1", "g2", "at", F.get("w", F.col("at"))]
        rest = found.where("not joins").select("l1", "l2", F.xxhash64(*side).alias("g1"), F.xxhash64(F.lit(7), *side).alias("g2"), "w")
        turn += 1


def line_dedup(docs: DataFrame, depth: int = DEPTH, alike: float = ALIKE, keep: list[str] | None = None) -> DataFrame:
    """Columns `keep` of docs (doc_id, if not given), with text (without dropped lines), n_lines and n_dropped, for each row.

    Lines end at \\n; empty ones (also of white space alone) stay. Lines of so few tokens that none may differ (four or
    less, as are most in scripts without spaces) recur only if they are equal, digits and all. Of the documents with a
    template, that with the least doc_id keeps its lines (also those that it repeats itself); rows with the same id are one
    document, and a null id comes last. A null text stays null (no lines). A text of which all lines are dropped becomes empty.
    Repeated rows come out as often as they go in; an empty table gives no rows. Other columns may have any names but those of
    the results. Texts are read whole, in time in proportion to their length.
    """
    keep = keep or ["doc_id"]
    rows = materialise(_lines(docs, depth, alike), "lines")
    # leaves of several documents; only their lines can recur
    leaves = rows.groupBy("g1", "g2").agg(*_span(), (F.min("l1") < F.max("l1")).alias("mixed")).where(MANY).select("g1", "g2", "mixed")
    leaves = materialise(leaves, "leaves")
    near = materialise(rows.join(small(leaves), ["g1", "g2"]).withColumn("m", F.when(F.col("mixed") & _may_differ(F.col("n"), alike), F.col("m"))), "near")
    discard(rows, leaves)
    kinds = materialise(near.groupBy("l1", "l2").agg(*_span()), "kinds")
    able = near.where("m is not null").groupBy("l1", "l2", "g1", "g2").agg(F.min("m").alias("m"))
    able = materialise(able.select("l1", "l2", "g1", "g2", F.transform(F.split("m", " ", -1), lambda x, i: F.xxhash64(i, x)).alias("w")), "able")
    template = materialise(_templates(able, alike), "members")

    # lines whose template is in several documents, with the document that keeps them
    members = kinds.join(small(template), ["l1", "l2"])
    spans = materialise(members.groupBy("t1", "t2").agg(*_spans()).where(MANY).select("t1", "t2", "first"), "spans")
    alone = kinds.where(MANY).join(small(template), ["l1", "l2"], "left_anti").select("l1", "l2", "first")
    again = alone.unionByName(template.join(small(spans), ["t1", "t2"]).select("l1", "l2", "first"))
    again = materialise(again, "again")
    drops = near.select("doc_id", "k", "pos", "l1", "l2").join(small(again), ["l1", "l2"]).where(~F.col("doc_id").eqNullSafe(F.col("first")))
    drops = drops.groupBy("doc_id", "k").agg(F.array_sort(F.collect_set("pos")).alias("gone"))
    drops = materialise(drops.select(F.col("doc_id").alias("_id"), F.col("k").alias("_k"), F.col("gone").alias("_gone")), "drops")
    discard(near, kinds, able, template, spans, again)

    kept = [F.col(c).alias(f"_keep{k}") for k, c in enumerate(keep)]
    data = docs.select(*kept, F.col("text").alias("_text"), F.col("doc_id").alias("_doc"), F.xxhash64("text").alias("_row"))
    out = data.join(small(drops), F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_row") == F.col("_k")), "left")

    def cut(x: Column) -> Column:
        """The lines between the positions that go."""
        start = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(x["gone"], i - 1) + 1)
        stop = lambda i: F.coalesce(F.get(x["gone"], i), F.size(x["lines"]))
        return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(x["gone"])), lambda i: F.slice(x["lines"], start(i) + 1, stop(i) - start(i)))), "\n")

    text = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(_let(F.struct(F.split("_text", "\n", -1).alias("lines"), F.col("_gone").alias("gone")), cut))
    n = F.octet_length("_text") - F.octet_length(F.replace("_text", F.lit("\n"), F.lit(""))) + 1
    return out.select(*[F.col(f"_keep{k}").alias(c) for k, c in enumerate(keep)], text.alias("text"), F.coalesce(n, F.lit(0)).alias("n_lines"), F.coalesce(F.size("_gone"), F.lit(0)).alias("n_dropped"))
