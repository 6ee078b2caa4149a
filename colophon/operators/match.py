"""Title matching: the decision tree, and the blocked fuzzy join with the best candidate of each entry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.functions import textnorm as T
from colophon.sources.tables import many, written

RANK = {"exact": 3, "fuzzy": 2, "weak": 1}


def prepared(df: DataFrame, title: str, authors: str, prefix: str) -> DataFrame:
    """df with the columns that the tree reads, once per row instead of once per pair."""
    t, a = F.col(title), F.col(authors)
    made = {"norm": T.norm(t), "tokens": T.tokens(t), "head": T.head(t), "sur": F.array_distinct(T.surnames(a)), "full": T.fullnames(a)}
    return df.select("*", *[c.alias(f"{prefix}{k}") for k, c in made.items()])


def measured(pairs: DataFrame, a: str = "a_", b: str = "b_") -> DataFrame:
    """Pairs of two prepared sides with the measures of the tree, each computed once."""
    c = lambda s: (F.col(f"{a}{s}"), F.col(f"{b}{s}"))
    (at, bt), (asur, bsur), (af, bf) = (c(s) for s in ("tokens", "sur", "full"))
    return pairs.withColumns({
        "_cont": T.containment(at, bt), "_jac": T.jaccard(at, bt), "_both": (F.size(af) > 0) & (F.size(bf) > 0), "_fo": F.size(F.array_intersect(af, bf)), "_ff": T.containment(af, bf),
        "_so": F.size(F.array_intersect(asur, bsur)), "_sf": T.containment(asur, bsur), "_few": (F.size(at) < 3) | (F.size(bt) < 3),
        "_nobody": ((F.size(asur) == 0) & (F.size(af) == 0)) | ((F.size(bsur) == 0) & (F.size(bf) == 0)), "_small": F.size(asur) <= 3,
    })


def decision(a: str = "a_", b: str = "b_") -> Column:
    """FN-10: struct(kind, score) of measured pairs."""
    cont, jac = F.col("_cont"), F.col("_jac")
    sim = F.greatest(cont, jac)
    fo, ff = F.when(F.col("_both"), F.col("_fo")).otherwise(0), F.when(F.col("_both"), F.col("_ff")).otherwise(0.0)
    so, sf = F.col("_so"), F.col("_sf")
    strong = F.when(F.col("_both"), ((fo >= 2) & (ff >= 0.5)) | (ff >= 0.75)).otherwise(((so >= 3) & (sf >= 0.5)) | (sf >= 0.75) | ((so >= 2) & F.col("_small")))
    an, bn, ah, bh = (F.col(x) for x in (f"{a}norm", f"{b}norm", f"{a}head", f"{b}head"))
    out = lambda kind, score: F.struct(F.lit(kind).cast("string").alias("kind"), score.cast("double").alias("score"))
    return (
        F.when((an != "") & (an == bn), out("exact", F.lit(1.0)))
        .when(F.col("_few"), out(None, F.lit(0.0)))
        .when(F.col("_nobody"), F.when((cont >= 0.9) & (jac >= 0.75), out("fuzzy", sim)).otherwise(out(None, sim)))
        .when(~strong, out(None, sim))
        .when((ah != "") & (ah == bh) & (cont >= 0.5), out("fuzzy", F.greatest(sim, F.lit(0.8))))
        .when((cont >= 0.75) & (jac >= 0.6), out("fuzzy", sim))
        .when((fo >= 4) & (ff >= 0.9), out("weak", sim))
        .otherwise(out(None, sim))
    )


def _keys(side: DataFrame, ident: str, p: str, often: DataFrame) -> DataFrame:
    """ident, k, {p}n, {p}at: block keys such that any two sides that the tree may match by a shared full name share one.

    A match that isn't of equal titles needs a shared name and: the same head; or a token similarity of 0.6, so that of both sides'
    tokens, rarest first, the leading 40 % have one in common; or four shared names, so two. A frequent name thus meets only
    records that are alike in one more thing. Keys by a token have its place (`at`) among the side's `n` tokens. Keys are hashed;
    equal hashes of different keys only add a pair for the tree.
    """
    tokens = side.select(ident, F.explode(f"{p}tokens").alias("token")).join(many(often), "token", "left")
    ranked = tokens.groupBy(ident).agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))).alias("t"))  # a title's tokens
    lead = F.size("t") - F.ceil(F.size("t") * 0.6 - 1e-9).cast("int") + 1
    second = lambda text, at: F.struct(text.alias("text"), at.cast("int").alias("at"))
    rows = side.join(many(ranked), ident).select(ident, F.col(f"{p}full").alias("who"), F.col(f"{p}head").alias("head"), F.size("t").alias("size"), F.slice("t", 1, lead).alias("t"))
    words = F.transform("t", lambda x, i: second(F.concat(F.lit("t "), x["token"]), i + 1))
    head = F.when(F.col("head") != "", F.array(second(F.concat(F.lit("h "), F.col("head")), F.lit(None)))).otherwise(F.array().cast("array<struct<text:string,at:int>>"))
    # a name with a head or a token; and of four names or more each pair, once
    key = lambda text, at: F.struct(F.xxhash64(text).alias("k"), at.cast("int").alias("at"))
    own = F.flatten(F.transform("who", lambda w: F.transform("second", lambda s: key(F.concat(w, F.lit("\n"), s["text"]), s["at"]))))
    both = F.flatten(F.transform("who", lambda w: F.transform(F.filter("who", lambda v: v > w), lambda v: key(F.concat(w, F.lit("\nn "), v), F.lit(None)))))
    keys = F.when(F.size("who") >= 4, F.concat("own", "both")).otherwise(F.col("own"))
    rows = rows.withColumn("second", F.concat(head, words)).withColumns({"own": own, "both": both})
    return rows.select(ident, F.col("size").alias(f"{p}n"), F.explode(F.array_distinct(keys)).alias("k")).select(ident, "k.k", f"{p}n", F.col("k.at").alias(f"{p}at"))


def _alike(side: DataFrame, ident: str, p: str) -> DataFrame:
    """side with `class`, equal for rows that the tree can't tell apart but by their titles' letters."""
    return side.withColumn("class", F.sha2(F.to_json(F.struct(F.array_sort(f"{p}tokens"), f"{p}head", F.array_sort(f"{p}sur"), F.array_sort(f"{p}full"))), 256))


def _classes(side: DataFrame, ident: str, p: str) -> DataFrame:
    """One row for each class: its least ident and what the tree reads; only classes that may match without equal titles."""
    cells = [f"{p}{c}" for c in ("tokens", "head", "sur", "full")]
    able = side.where((F.size(f"{p}tokens") >= 3) & (F.size(f"{p}full") > 0))
    one = able.groupBy("class").agg(F.min(ident).alias(ident), F.min_by(F.struct(*cells), ident).alias("c"))
    return one.select("class", ident, "c.*", F.lit("").alias(f"{p}norm"))


def best_matches(catalogue: DataFrame, records: DataFrame) -> DataFrame:
    """JN-10, JN-11, WN-06: for each entry of the catalogue (id, title, authors) its best record (rec, rec_title, rec_authors).

    Both sides are prepared and written once. Records with the same normalised title come first (an equi-join with the least
    record of each title). Of the others, rows with the same tokens, head and names are one class; classes meet only under a shared
    block key (`_keys`: a full name and one more thing, without loss). The first token that two lists share bounds how many they
    can share, so pairs that can't reach a similarity of 0.6 by any of their keys go before their arrays are read; pairs are made
    distinct, and the tree decides. The best is that of the highest kind, then score, then the least record id. Entries without a
    match have no row.
    """
    cols = lambda ident, p: [ident, *[f"{p}{c}" for c in ("norm", "tokens", "head", "sur", "full")]]
    a = written(_alike(prepared(catalogue, "title", "authors", "a_").select(*cols("id", "a_")), "id", "a_"), "entries")
    b = written(_alike(prepared(records, "rec_title", "rec_authors", "b_").select(*cols("rec", "b_")), "rec", "b_"), "records")
    titles = b.where("b_norm <> ''").groupBy(F.col("b_norm").alias("a_norm")).agg(F.min("rec").alias("rec"))
    same = a.select("id", "a_norm").join(many(titles), "a_norm").groupBy("id").agg(F.min("rec").alias("rec"))
    exact = same.select("id", "rec", F.lit("exact").alias("kind"), F.lit(1.0).alias("score"))
    left = a.join(many(same.select("id")), "id", "left_anti")
    one_a, one_b = written(_classes(left, "id", "a_"), "entry-classes"), written(_classes(b, "rec", "b_"), "record-classes")
    often = one_b.select(F.explode("b_tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    met = _keys(one_a, "id", "a_", often).join(many(_keys(one_b, "rec", "b_", often)), "k")
    most = 1 + F.least(F.col("a_n") - F.col("a_at"), F.col("b_n") - F.col("b_at"))  # tokens that both can share, if this is the first one
    pairs = met.where(F.col("a_at").isNull() | F.col("b_at").isNull() | (1.6 * most >= 0.6 * (F.col("a_n") + F.col("b_n")) - 1e-6)).select("id", "rec").distinct()
    scored = measured(pairs.join(many(one_a), "id").drop("class").join(many(one_b.drop("class")), "rec")).select("id", "rec", decision().alias("m"))
    scored = scored.where("m.kind is not null").select("id", "rec", "m.kind", "m.score")
    rank = F.create_map(*[F.lit(x) for kv in RANK.items() for x in kv])[F.col("kind")]
    best = scored.groupBy("id").agg(F.min_by(F.struct("rec", "kind", "score"), F.struct(-rank, -F.col("score"), F.col("rec"))).alias("m"))
    of_class = one_a.select("class", "id").join(many(best), "id").select("class", "m")
    rest = left.select("id", "class").join(many(of_class), "class").select("id", "m.*")
    first = rest.groupBy("id").agg(F.min_by(F.struct("rec", "kind", "score"), F.struct(-rank, -F.col("score"), F.col("rec"))).alias("m"))  # an id may be there twice
    return exact.unionByName(first.select("id", "m.*"))
