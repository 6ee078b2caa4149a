"""Document quality by pairwise ranking (Bradley-Terry).

Each text gives style features: shares of characters by kind, word and line statistics, repetition. Each is cut into steps at
quantiles, so that the linear score can bend. The score is learned from pairs of a good and a bad document, by logistic loss on
the differences of their features. The threshold is a quantile of the scores of all labelled training rows, at their share of
bad labels, and the score is shifted so that the threshold becomes 0.7.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.llm._common import materialise, small

#: Labelled rows in the sample, by halves of either label; steps of a feature; pairs; passes; penalty; the cut's score.
SAMPLE, STEPS, PAIRS, ROUNDS, PENALTY, CUT = 6000, 12, 40_000, 300, 1e-3, 0.7
_PUNCT = np.frombuffer(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", np.uint8)


def features(text: str | None) -> np.ndarray:
    """Style features of a text, whole; a null text counts as empty."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    c = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) if raw else np.zeros(256, int)
    n = max(len(raw), 1)
    words = text.split()
    lower = text.lower().split()
    lines = [x for x in text.split("\n") if x.strip()]
    w, k = max(len(words), 1), max(len(lines), 1)
    lengths = np.array([len(x) for x in words] or [0])
    distinct = len(set(lower))
    line_words = np.array([x.count(" ") + 1 for x in lines] or [0])
    ends = sum(1 for x in lines if x.rstrip()[-1:] in ".!?\"'”»")
    pairs = len(set(zip(lower, lower[1:], strict=False))) / max(len(lower) - 1, 1)
    upper = sum(1 for x in words if x.isupper() and len(x) > 1)
    style = [
        np.log1p(len(text)), np.log1p(len(words)), np.log1p(len(lines)), lengths.mean(), lengths.std(), lengths.max(),
        (lengths <= 3).mean(), (lengths >= 12).mean(), distinct / w, distinct / w**0.75, pairs, len(set(lines)) / k, line_words.mean(), line_words.std(), ends / k,
        upper / w, sum(1 for x in words if x[:1].isupper()) / w, sum(1 for x in words if not any(map(str.isalnum, x))) / w,
        sum(1 for x in words if x[-1:] in ".!?") / w, c[48:58].sum() / n, c[65:91].sum() / n, c[97:123].sum() / n, c[128:].sum() / n, c[_PUNCT].sum() / n, c[32] / n, c[10] / k,
    ]
    return np.array([*style, *(c[_PUNCT] / n)], np.float32)


@dataclass
class Ranking:
    cuts: np.ndarray  # features x steps
    weights: np.ndarray

    def bent(self, x: np.ndarray) -> np.ndarray:
        return (x[:, :, None] > self.cuts[None]).reshape(len(x), -1).astype(np.float32)

    def score(self, x: np.ndarray) -> np.ndarray:
        return (self.bent(x) @ self.weights).astype(np.float64)


def _learn(good: np.ndarray, bad: np.ndarray, seed: int = 1) -> Ranking:
    x = np.concatenate((good, bad))
    cuts = np.quantile(x, np.linspace(0, 1, STEPS + 2)[1:-1], axis=0).T.astype(np.float32)
    model = Ranking(cuts, np.zeros(cuts.size, np.float32))
    g, b = model.bent(good), model.bent(bad)
    rng = np.random.default_rng(seed)
    i, j = rng.integers(0, len(g), PAIRS), rng.integers(0, len(b), PAIRS)
    w, m, v = model.weights, np.zeros_like(model.weights), np.zeros_like(model.weights)
    for t in range(1, ROUNDS + 1):  # Adam on blocks of pairs
        at = rng.integers(0, PAIRS, 2000)
        d = g[i[at]] - b[j[at]]
        grad = -(d / (1 + np.exp(np.clip(d @ w, -30, 30)))[:, None]).mean(axis=0) + PENALTY * w
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        w -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return model


def _with_features(rows: DataFrame, keep: list[str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [features(t).tobytes() for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(cells, pa.binary())], [*batch.schema.names[:-1], "x"])

    data = rows.select(*keep, F.col("text").alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in data.schema.fields[:-1])
    return data.mapInArrow(run, f"{fields}, x binary")


def known_labels(labels: DataFrame) -> DataFrame:
    """doc_id and quality of the ids that have a label, and only one."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
    return known.where("quality = most").select("doc_id", "quality")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ranking | None:
    """The ranking from labelled texts, at most sample/2 ids of either label, drawn by a hash; None if a label has no text.

    labels: doc_id, quality; an id with both labels, or a null id or label, teaches nothing.
    """
    known = known_labels(labels).withColumn("h", F.xxhash64("doc_id"))
    picked = [known.where(F.col("quality") == q).orderBy("h", "doc_id").limit(sample // 2).select("doc_id", "quality") for q in (0, 1)]
    picked = small(materialise(picked[0].unionByName(picked[1]), "sample"))
    rows = docs.select("doc_id", "text").join(picked, "doc_id")
    got = _with_features(rows, ["doc_id", "quality"]).groupBy("doc_id").agg(F.min(F.struct("quality", "x")).alias("r")).orderBy("doc_id").collect()
    x = np.stack([np.frombuffer(r["r"]["x"], np.float32) for r in got]) if got else np.zeros((0, 1), np.float32)
    y = np.array([r["r"]["quality"] for r in got])
    return _learn(x[y == 1], x[y == 0]) if (y == 1).any() and (y == 0).any() else None


def quality(docs: DataFrame, labels: DataFrame, training: Column | None = None, sample: int = SAMPLE) -> DataFrame:
    """doc_id, score (0 to 1, higher: label 1 is likelier) and predicted (1 if score >= 0.7) for each row of docs.

    Learned from labels (doc_id, quality) for whose doc_id `training` holds. A score reads text alone; null counts as empty.
    Without rows of both labels all scores are 0.5. Repeated rows come out as often as they go in; null ids are kept.
    """
    taught = labels if training is None else labels.where(training)
    model = fit(docs, taught, sample)
    held = docs.sparkSession.sparkContext.broadcast(model)  # features x steps numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                x = np.stack([features(t) for t in batch.column("text").to_pylist()])
                s = m.score(x) if m else np.zeros(len(x))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s)], ["doc_id", "s"])

    kind = docs.select("doc_id").schema[0].dataType
    scored = materialise(docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind.simpleString()}, s double"), "scores")
    if model is None:
        return scored.select("doc_id", F.lit(0.5).alias("score"), F.lit(0).alias("predicted"))
    marks = known_labels(taught)
    own = scored.join(marks, "doc_id")
    share = own.agg(F.avg(1 - F.col("quality"))).first()[0]
    cut = own.agg(F.percentile_approx("s", F.lit(float(share)), F.lit(100_000))).first()[0]
    score = 1 / (1 + F.exp(-(F.col("s") - F.lit(cut) + F.lit(float(np.log(CUT / (1 - CUT)))))))
    return scored.select("doc_id", score.alias("score")).withColumn("predicted", (F.col("score") >= CUT).cast("int"))
