"""Queries over the operators of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.llm._common import bucket_of
from colophon.llm.decontaminate import contaminated
from colophon.llm.exact_dedup import exact_dedup
from colophon.llm.hard_negatives import hard_negatives
from colophon.llm.html_text import extract
from colophon.llm.language import identify
from colophon.llm.line_dedup import line_dedup
from colophon.llm.lm_score import lm_scores
from colophon.llm.minhash import minhash_components
from colophon.llm.packing import pack
from colophon.llm.privacy import key_of, pseudonymise
from colophon.llm.quality import quality
from colophon.llm.simhash import simhash_components
from colophon.llm.vector_codes import vector_codes


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the document that stays of its group of equal texts."""
    return exact_dedup(_table(spark, sf_dir, "documents"))


SQL_OP1 = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and the least document of its near-duplicates."""
    return simhash_components(_table(spark, sf_dir, "documents"))


def op4_privacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced by pseudonyms of the same format."""
    return pseudonymise(_table(spark, sf_dir, "documents"), key_of(spark))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines whose template an earlier document has."""
    return line_dedup(_table(spark, sf_dir, "documents"))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the installed package of public tokenizers keeps a file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document contains, with the document."""
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


SQL_OP3 = r"""
WITH w AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark),
     i AS (SELECT DISTINCT item_id, unnest([array_to_string(w[x:x+4], ' ') FOR x IN range(1, len(w) - 3)]) AS s FROM w WHERE len(w) >= 5),
     n AS (SELECT item_id, count(*) AS n_shingles FROM i GROUP BY 1),
     v AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
     d AS (SELECT DISTINCT doc_id, unnest([array_to_string(w[x:x+4], ' ') FOR x IN range(1, len(w) - 3)]) AS s FROM v WHERE len(w) >= 5),
     c AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN i USING (s) GROUP BY 1, 2)
SELECT doc_id, item_id, n_shingles::INT AS n_shingles, n_shared, n_shared / n_shingles AS containment
FROM c JOIN n USING (item_id) WHERE n_shared >= 0.8 * n_shingles
"""


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens, with a checksum of each piece's ids."""
    return digest(pack(_table(spark, sf_dir, "documents"), tokenizer_path()))


def digest(pieces: DataFrame) -> DataFrame:
    """Packed pieces with a checksum for their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document by a language model learned from six sevenths of them."""
    return lm_scores(_table(spark, sf_dir, "documents"), bucket_of(F.col("doc_id"), 7) == 2)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from two thirds of them."""
    out = identify(_table(spark, sf_dir, "documents"), bucket_of(F.col("doc_id"), 3) != 1)
    return out.select("doc_id", (bucket_of(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score", "rejected")


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(_table(spark, sf_dir, "pages"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document, learned from three quarters of the labels."""
    out = quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), bucket_of(F.col("doc_id"), 4) != 2)
    return out.select("doc_id", (bucket_of(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted")


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the least document of its near-duplicates by three-word shingles."""
    return minhash_components(_table(spark, sf_dir, "documents"))


SQL_OP11 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents WHERE text IS NOT NULL),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct([array_to_string(w[k:k+2], ' ') FOR k IN range(1, len(w) - 1)]) END) AS s
  FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 85 * (x.n + y.n - m)),
reach AS (SELECT a AS doc_id, a AS other FROM link UNION SELECT r.doc_id, l.b FROM reach r JOIN link l ON l.a = r.other),
c AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id, d.doc_id = coalesce(c.component_id, d.doc_id) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector as a code of sixteen parts, with its error."""
    return vector_codes(_table(spark, sf_dir, "embeddings"), "embedding")


def _sql_op12(rounds: int = 2) -> str:
    # parts as (vec_id, part, list of integers); a round's codebook as (part, entry, list)
    near = """SELECT x.vec_id, x.part, min_by(b.entry, (d, b.entry)) AS entry, min(d) AS d FROM x JOIN b{k} b USING (part),
      LATERAL (SELECT list_sum([(x.v[i] - b.v[i]) * (x.v[i] - b.v[i]) FOR i IN range(1, len(x.v) + 1)]) AS d) GROUP BY ALL"""
    steps = []
    for k in range(rounds):
        steps.append(f"a{k} AS MATERIALIZED ({near.format(k=k)})")
        steps.append(f"""m{k} AS (SELECT part, entry, list(m ORDER BY i) AS v FROM (
            SELECT part, entry, i, CAST(floor(CAST(sum(x.v[i]) AS DOUBLE) / count(*)) AS BIGINT) AS m
            FROM a{k} JOIN x USING (vec_id, part), (SELECT unnest(range(1, 5)) AS i) GROUP BY ALL) GROUP BY ALL)""")
        steps.append(f"b{k + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.v, b.v) AS v FROM b{k} b LEFT JOIN m{k} m USING (part, entry))")
    return f"""
WITH e AS (SELECT vec_id, label, [CAST(floor(256 * CAST(u AS DOUBLE)) AS BIGINT) FOR u IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda u: u IS NULL OR NOT isfinite(u))) = 0),
x AS MATERIALIZED (SELECT vec_id, part, v[4 * part + 1 : 4 * part + 4] AS v FROM e, (SELECT unnest(range(16)) AS part)),
f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM e ORDER BY vec_id LIMIT 64),
b0 AS MATERIALIZED (SELECT part, entry, v FROM f JOIN x USING (vec_id)),
{", ".join(steps)},
z AS MATERIALIZED ({near.format(k=rounds)}),
c AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM z GROUP BY 1),
g AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM c JOIN e USING (vec_id), g
"""


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every hundredth vector and its five best positives the hard negatives; one label in seven is shifted."""
    rows = _table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 100 == 0, "embedding")


SQL_OP13 = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * CAST(u AS DOUBLE)) FOR u IN embedding] AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda u: u IS NULL OR NOT isfinite(u))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a, e b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) QUALIFY rank <= 10
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_dedup": op1_exact_dedup,
        "op2_simhash": op2_simhash,
        "op3_decontaminate": op3_decontaminate,
        "op4_privacy": op4_privacy,
        "op5_packing": op5_packing,
        "op6_lm_score": op6_lm_score,
        "op7_language": op7_language,
        "op8_html_text": op8_html_text,
        "op9_line_dedup": op9_line_dedup,
        "op10_quality": op10_quality,
        "op11_minhash": op11_minhash,
        "op12_vector_codes": op12_vector_codes,
        "op13_hard_negatives": op13_hard_negatives,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": SQL_OP1,
        "op3_decontaminate": SQL_OP3,
        "op11_minhash": SQL_OP11,
        "op12_vector_codes": _sql_op12(),
        "op13_hard_negatives": SQL_OP13,
    }
