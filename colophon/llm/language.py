"""Language identification by nearest centroid.

Texts become normalised TF-IDF vectors of hashed letter pairs and triples. Of each language, several centroids are found by
spherical k-means on a bounded sample of labelled rows. A text gets the language of the centroid with the largest cosine; it is
rejected if that cosine is far below those of the rows from which the centroid was made, and of pieces of them that are as short
as the text: short texts are nearer to no centroid, so each size has a floor of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hashed dimensions; labelled rows in the sample over all languages; centroids of a language.
DIMS, SAMPLE, CENTROIDS = 4096, 4000, 4
#: A cosine below this share of its centroid's low training cosines (their 0.001 quantile) is too distant.
REJECT = 0.5
#: Sizes of a text by powers of two of its letter groups; words of the pieces by which the floors of the sizes
#: are found; one in EACH sampled texts is cut into pieces.
SIZES, PIECES, EACH = 24, (1, 2, 4, 8, 16, 32, 64), 4
#: Scale of cosines in the score.
SHARP = 40.0
LETTER = regex.compile(r"\p{L}")
#: Characters of a text that are counted at once.
SLICE = 1 << 20
#: Bytes to bytes: ASCII that isn't a letter becomes a space.
_CLEAN = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def _slices(text: str) -> Iterator[str]:
    """Parts of a text, cut at spaces where there are any in reach."""
    at = 0
    while len(text) - at > 2 * SLICE:
        cut = text.find(" ", at + SLICE, at + 2 * SLICE)
        cut = at + SLICE if cut < 0 else cut
        yield text[at:cut]
        at = cut
    yield text[at:]


def counts(text: str) -> np.ndarray:
    """Hashed counts of the letter pairs and triples (in UTF-8) of the lower-cased words of text."""
    out = np.zeros(DIMS, np.int64)
    shift = np.uint32(32 - DIMS.bit_length() + 1)
    for part in _slices(text):
        b = b" ".join(part.lower().encode("utf-8", "surrogatepass").translate(_CLEAN).split())
        b = np.frombuffer(b" " + b + b" ", np.uint8).astype(np.uint32)
        pairs = b[:-1] << np.uint32(8) | b[1:]
        triples = pairs[:-1] << np.uint32(8) | b[2:]
        for x, by in ((pairs, 2654435761), (triples, 2246822519)):
            out += np.bincount((x * np.uint32(by) >> shift).astype(np.int32), minlength=DIMS)
    return out


def _size(groups: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(groups, 1)).astype(int).clip(0, SIZES - 1)


@dataclass
class Centroids:
    languages: list[str]  # of each centroid
    idf: np.ndarray
    matrix: np.ndarray  # centroids x DIMS, normalised
    floor: np.ndarray  # centroids x SIZES: the cosine below which a text of the size is rejected

    def vectors(self, tf: np.ndarray) -> np.ndarray:
        v = np.log1p(tf, dtype=np.float32) * self.idf
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)

    def predict(self, tf: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Languages, scores and rejections of rows of counts."""
        cos = self.vectors(tf) @ self.matrix.T
        best = cos.argmax(axis=1)
        top = cos[np.arange(len(cos)), best]
        names = sorted(set(self.languages))
        by = np.stack([cos[:, [k for k, x in enumerate(self.languages) if x == n]].max(axis=1) for n in names], axis=1)
        e = np.exp(SHARP * (by - by.max(axis=1, keepdims=True)).astype(np.float64))
        return [self.languages[k] for k in best], np.clip(e.max(axis=1) / e.sum(axis=1), 0, 1), top < self.floor[best, _size(tf.sum(axis=1))]


def _kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from centres that are far apart; deterministic."""
    centres = [x.mean(axis=0)]
    centres[0] /= max(np.linalg.norm(centres[0]), 1e-9)
    while len(centres) < min(k, len(x)):
        near = (x @ np.stack(centres).T).max(axis=1)
        far = np.argsort(near)[: max(1, len(x) // 20)]  # the mean of the farthest, not one outlier
        c = x[far].mean(axis=0)
        centres.append(c / max(np.linalg.norm(c), 1e-9))
    c = np.stack(centres)
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        sums = np.stack([x[own == j].sum(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
        c = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    return c


def fit(docs: DataFrame, sample: int = SAMPLE, centroids: int = CENTROIDS) -> Centroids | None:
    """Centroids from a sample of docs (doc_id, text, lang), in equal parts for each language; None of no labelled text.

    The sample is drawn by a hash of id and text, so that rows that share an id are drawn apart, at most sample/languages rows each; document frequencies and floors are the sample's.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sizes = {r["lang"]: r["count"] for r in docs.where(F.col("lang").isNotNull()).groupBy("lang").count().collect()}  # a row for each language
    if not sizes:
        return None
    each = max(1, sample // len(sizes))
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000))
    share = F.create_map(*[F.lit(x) for name, n in sizes.items() for x in (name, min(1_000_000, int(1_500_000 * each / n) + 1))])
    rows = rows.where(draw < share[F.col("lang")])
    # the hash of a repeated row may pass many rows; the rank bounds them
    w = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", F.lit(7)), F.xxhash64("text"))
    rows = rows.select("lang", "doc_id", "text").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= each)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of whole texts (piece 0), and of pieces of the given numbers of words from their middle."""
        names = ["lang", "rank", "piece", "at", "n"]
        for whole in batches:
            for start in range(0, whole.num_rows, 100):
                batch = whole.slice(start, 100)
                rows = []
                for lang, rank, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "rank", "text")), strict=True):
                    middle = text[len(text) // 2 :].split(None, max(PIECES) + 1)[1 : max(PIECES) + 1]
                    for n, t in ((0, text), *((n, " ".join(middle[:n])) for n in PIECES if n <= len(middle) and rank % EACH == 0)):
                        tf = counts(t).astype("<u4")
                        at = np.flatnonzero(tf).astype("<u2")
                        rows.append((lang, rank, n, at.tobytes(), tf[at].tobytes()))
                kinds = (pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    got = rows.select("lang", "rank", "text").mapInArrow(run, "lang string, rank int, piece int, at binary, n binary").collect()  # a bounded number of rows for each of the sample
    got.sort(key=lambda r: (r["piece"], r["lang"], r["rank"]))
    if not got:
        return None

    def vectors(rows: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Vectors and numbers of letter groups, a few hundred rows at a time."""
        for start in range(0, len(rows), 250):
            part = rows[start : start + 250]
            tf = np.zeros((len(part), DIMS), np.float32)
            for k, r in enumerate(part):
                tf[k, np.frombuffer(r["at"], "<u2")] = np.frombuffer(r["n"], "<u4")
            yield model.vectors(tf), tf.sum(axis=1)

    texts = [r for r in got if r["piece"] == 0]
    frequency = np.bincount(np.concatenate([np.frombuffer(r["at"], "<u2") for r in texts]), minlength=DIMS)
    idf = np.log((1 + len(texts)) / (1 + frequency)).astype(np.float32) + 1
    model = Centroids([], idf, np.zeros((0, DIMS), np.float32), np.zeros((0, SIZES)))
    x, lang = np.concatenate([v for v, _ in vectors(texts)]), np.array([r["lang"] for r in texts], dtype=object)
    parts = []
    for name in sorted(set(lang)):
        parts.append(_kmeans(x[lang == name], centroids))
        model.languages += [name] * len(parts[-1])
    model.matrix = np.concatenate(parts).astype(np.float32)
    del x
    # cosines of texts and pieces with their centroid; a floor is that of the size, or of smaller ones, whichever is lowest of larger
    model.floor = np.full((len(model.matrix), SIZES), np.inf)
    for v, groups in vectors(got):
        cos = v @ model.matrix.T
        np.minimum.at(model.floor, (cos.argmax(axis=1), _size(groups)), cos.max(axis=1))
    model.floor = REJECT * np.where(np.isinf(model.floor), 0, np.minimum.accumulate(model.floor[:, ::-1], axis=1)[:, ::-1])
    for size in range(1, SIZES):  # larger than any text of the sample: as the largest
        missing = model.floor[:, size] == 0
        model.floor[missing, size] = model.floor[missing, size - 1]
    return model


def identify(docs: DataFrame, training: Column | None = None, sample: int = SAMPLE, keep: list[str] | None = None) -> DataFrame:
    """Columns `keep` of docs (doc_id, if not given), with lang_pred, score (0 to 1) and rejected, for each row.

    Learned from rows of docs for which `training` holds (all, if not given) and lang isn't null; a prediction reads text alone.
    A null text and one without any letter get `und`, score 0 and are rejected, as are all rows if nothing can be learned.
    Empty and very long texts are read whole, in slices; repeated rows come out as often as they go in; null ids are kept. Columns
    of docs may have any names; `keep` should hold narrow ones, as they pass through Python.
    """
    keep = keep or ["doc_id"]
    model = fit(docs if training is None else docs.where(training), sample)
    names = [f"c{k}" for k in range(len(keep))]
    data = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names, strict=True)], F.col("text").alias("t"))
    held = docs.sparkSession.sparkContext.broadcast(model)  # centroids x DIMS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for whole in batches:
            for start in range(0, whole.num_rows, 100):
                batch = whole.slice(start, 100)
                texts = batch.column("t").to_pylist()
                lang, score, out = ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
                at = [k for k, t in enumerate(texts) if t and LETTER.search(t)] if m else []
                if at:
                    found, s, far = m.predict(np.stack([counts(texts[k]) for k in at]))
                    for k, name in zip(at, found, strict=True):
                        lang[k] = name
                    score[at], out[at] = s, far
                cols = [*batch.columns[:-1], pa.array(lang, pa.string()), pa.array(score), pa.array(out)]
                yield pa.RecordBatch.from_arrays(cols, [*names, "lang_pred", "score", "rejected"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in data.schema.fields[:-1])
    out = data.mapInArrow(run, f"{fields}, lang_pred string, score double, rejected boolean")
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], "lang_pred", "score", "rejected")
