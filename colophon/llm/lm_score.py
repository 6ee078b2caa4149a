"""Document scores by a hashed maximum-entropy language model with a class-factored softmax.

P(word | before) = P(class | before) P(group | class, before) P(word | group). A word's class is a hash of its spelling (short
words) or of its ending, its group a hash of the whole word within the class. The first two factors are mixtures of models with
n-gram and skip features. For the class: a maximum-entropy model over hashed features of the classes one and two before and both
together; and, as features of words, the hashed word before and the hashed word two before, each with its own softmax over the
classes. For the group: its share in the class, and softmaxes given the hashed word before and two before. A softmax with one
hashed feature at a time is fitted in closed form from the counts of all training tokens, drawn towards the model without the
feature by a prior; the maximum-entropy weights and then the mixture are trained by distributed updates. P(word | group) is
smoothed from the training count of each word, with one share for all unknown words of the group, so the model sums to one.

First pass: texts are cut into words where they are read, and written as chunks: the numbers of their words in the chunk's own
vocabulary, that vocabulary's hashes (96 bits) and training counts, dealt into parts, and the task's counts of classes and groups
after hashed words. All go as packed arrays, so Spark moves few rows. Each part then adds up the counts of its words over all
chunks, in numpy, and gives each chunk its words' corpus counts. Second pass: each chunk meets these and is scored in batches.
"""

from __future__ import annotations

import contextlib
import ctypes
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colophon.llm._common import discard, materialise

#: Classes (the last two: end of text, and before its start), groups of a class, hashed words before of a class, hashed pair
#: features, updates of the maximum-entropy model, their step, its prior's weight in counts, the other softmaxes' prior, updates of
#: the mixtures, parts of the count tables.
CLASSES, GROUPS, BEFORE, PAIRS, UPDATES, STEP, PRIOR, DRAW, MIXES, PARTS = 128, 32, 4, 2048, 16, 0.4, 10.0, 30.0, 4, 8
END, START = CLASSES - 2, CLASSES - 1
#: Characters after which a chunk ends; words of a block of which one update of the mixtures learns.
CHUNK, BLOCK = 2_000_000, 1 << 14
#: Cells of the count tables: class triples; groups after the hashed word before; after that two before.
TABLES = (CLASSES**3, CLASSES * BEFORE * CLASSES * GROUPS, CLASSES * BEFORE * CLASSES * GROUPS)


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays, their bytes put in planes (high bytes are mostly zero) and compressed."""
    out = [len(arrays).to_bytes(4, "little")]
    for a in arrays:
        planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()
        x = pa.compress(planes, codec="zstd", asbytes=True) if planes else b""
        out += [np.array([len(a), len(x)], "<i8").tobytes(), a.dtype.str.encode().ljust(4), x]
    return b"".join(out)


def _unpacked(blob: bytes) -> list[np.ndarray]:
    out, at = [], 4
    for _ in range(int.from_bytes(blob[:4], "little")):
        (n, size), kind = np.frombuffer(blob, "<i8", 2, at).tolist(), np.dtype(blob[at + 16 : at + 20].decode().strip())
        x = pa.decompress(blob[at + 20 : at + 20 + size], n * kind.itemsize, codec="zstd", asbytes=True) if size else b""
        out.append(np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(kind.itemsize, n).T).view(kind).reshape(n) if n else np.empty(0, kind))
        at += 20 + size
    return out


def _tidy(run):
    """run, after which the worker gives memory that it no longer uses back to the system, as it stays for later tasks."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # another C library than glibc
            ctypes.CDLL(None).malloc_trim(0)

    return tidied


def word_class(word: bytes) -> int:
    return zlib.crc32(word if len(word) <= 4 else word[-3:]) % END


def _codes(words: list[bytes]) -> np.ndarray:
    """Of each word the class and, below it, eight bits of its own."""
    own = np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) >> np.uint32(24)
    return np.fromiter(map(word_class, words), np.int32, len(words)) << 8 | own.astype(np.int32)


def _hashes(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    h = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), "<u8").reshape(-1, 2)
    return h[:, 0].astype("<i8"), h[:, 1].astype("<i4")


class _Numbers(dict):
    """Numbers words in the order in which they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _contexts(classes: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts with lens words, one after another: the classes of their tokens (an end after each) and those one and two before."""
    now = np.full(len(classes) + len(lens), END, np.int64)
    ends = np.cumsum(lens + 1) - 1
    inside = np.ones(len(now), bool)
    inside[ends] = False
    now[inside] = classes
    one = np.concatenate(([START], now[:-1]))
    two = np.concatenate(([START, START], now[:-2]))[: len(now)]
    first = ends - lens
    one[first] = START
    two[first] = START
    second = first[lens > 0] + 1
    two[second] = START
    return now, one, two


def _steps(codes: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of texts: classes of tokens, one and two before; the group of each token, and the hashed words one and two before."""
    now, one, two = _contexts(codes >> 8, lens)
    own, own1, own2 = _contexts(codes & 255, lens)
    of = lambda c, x, size: np.where(c < END, c * size + x % size, c * size)
    return now, one, two, of(now, own, GROUPS), of(one, own1 // GROUPS, BEFORE), of(two, own2 // GROUPS, BEFORE)


def _chunks(docs: DataFrame, held_out: Column, chunk: int, parts: int) -> DataFrame:
    """kind 0: words of a chunk's vocabulary in one part; 1: a chunk's texts; 2 and on: counts of a task in one part of a table."""
    kind = docs.select("doc_id").schema[0].dataType
    fields = ["kind", "chunk", "part", "blob", "docs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        tables = [np.zeros(n, np.int32) for n in TABLES]  # a task's counts
        id_type = None

        def row(k: int, part: int, blob: bytes, ids: list | None = None) -> pa.RecordBatch:
            cells = [pa.array([k], pa.int32()), pa.array([number], pa.int64()), pa.array([part], pa.int32()), pa.array([blob], pa.binary()), pa.array([ids], pa.list_(id_type))]
            return pa.RecordBatch.from_arrays(cells, fields)

        def flush() -> Iterator[pa.RecordBatch]:
            words = list(vocabulary)
            codes, (h1, h2) = _codes(words), _hashes(words)
            sizes, out = np.array(lens, "<i4"), np.array(held, np.uint8)
            all_ids = np.concatenate(ids).astype("<i4")
            of_train = np.repeat(out == 0, sizes)
            counts = np.bincount(all_ids[of_train], minlength=len(words)).astype("<i4")
            train, of_text = all_ids[of_train], sizes[out == 0].astype(np.int64)
            for t, w in _tokens(train, of_text, 1 << 18):
                now, one, two, group, hv, hu = _steps(codes[train[w]], of_text[t])
                for table, cells in zip(tables, ((two * CLASSES + one) * CLASSES + now, hv * CLASSES * GROUPS + group, hu * CLASSES * GROUPS + group), strict=True):
                    table += np.bincount(cells, minlength=len(table)).astype(np.int32)
            dealt = h1.view("<u8") % np.uint64(parts)
            order = np.argsort(dealt, kind="stable")
            cuts = np.searchsorted(dealt[order], np.arange(parts + 1, dtype=np.uint64))
            for k in range(parts):
                at = order[cuts[k] : cuts[k + 1]].astype("<i4")
                if len(at):
                    yield row(0, k, _packed(h1[at], h2[at], at, counts[at], codes[at].astype("<i4")))
            yield row(1, 0, _packed(all_ids, sizes, out, codes.astype("<i4")), doc_ids)

        vocabulary, ids, lens, held, doc_ids, size = _Numbers(), [], [], [], [], 0
        for whole in batches:
            id_type = whole.schema.field("doc_id").type
            for start in range(0, whole.num_rows, 200):
                batch = whole.slice(start, 200)
                for doc, text, out in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "held")), strict=True):
                    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
                    ids.append(np.fromiter(map(vocabulary.__getitem__, words), np.int32, len(words)))
                    lens.append(len(words))
                    held.append(out)
                    doc_ids.append(doc)
                    size += len(text or "") + 1
                    if size > chunk:
                        yield from flush()
                        vocabulary, ids, lens, held, doc_ids, size = _Numbers(), [], [], [], [], 0
                        number += 1
        if lens:
            yield from flush()
        for t, table in enumerate(tables):
            at = np.flatnonzero(table)
            cuts = np.searchsorted(at, np.arange(PARTS + 1) * (len(table) // PARTS))
            for k in range(PARTS):
                part = at[cuts[k] : cuts[k + 1]]
                if len(part):
                    yield row(2 + t, k, _packed(part.astype("<i4"), table[part]))

    schema = f"kind int, chunk long, part int, blob binary, docs array<{kind.simpleString()}>"
    return docs.select("doc_id", "text", held_out.alias("held")).mapInArrow(_tidy(run), schema)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of parts of tables: their sums, one row for each."""
    sums: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for kind, part, blob in zip(*(batch.column(c).to_pylist() for c in ("kind", "part", "blob")), strict=True):
            at, n = _unpacked(blob)
            size = TABLES[kind - 2] // PARTS
            np.add.at(sums.setdefault((kind, part), np.zeros(size, np.int64)), at - part * size, n)
    for (kind, part), x in sums.items():
        at = np.flatnonzero(x)
        cells = [pa.array([kind], pa.int32()), pa.array([part], pa.int32()), pa.array([_packed((at + part * len(x)).astype("<i4"), x[at])], pa.binary())]
        yield pa.RecordBatch.from_arrays(cells, ["kind", "part", "blob"])


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one part or more: for each chunk the corpus counts of its words; and, as chunk -1, the counts and words of each group."""
    by_part: dict[int, list[tuple[int, list[np.ndarray]]]] = {}
    for batch in batches:
        for chunk, part, blob in zip(*(batch.column(c).to_pylist() for c in ("chunk", "part", "blob")), strict=True):
            by_part.setdefault(part, []).append((chunk, _unpacked(blob)))
    for rows in by_part.values():
        h1, h2, local, n, codes = (np.concatenate(x) for x in zip(*(r for _, r in rows), strict=True))
        order = np.lexsort((h2, h1))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(h1[order]) != 0) | (np.diff(h2[order]) != 0)
        first = np.flatnonzero(new)
        total = np.add.reduceat(n[order].astype(np.int64), first)
        count = np.empty(len(order), np.int64)
        count[order] = np.repeat(total, np.diff([*first, len(order)]))
        known = total > 0
        code = codes[order[first]][known]
        group = (code >> 8) * GROUPS + (code & 255) % GROUPS
        sums = np.bincount(group, total[known], CLASSES * GROUPS).astype(np.int64), np.bincount(group, minlength=CLASSES * GROUPS)
        cuts = np.cumsum([0, *(len(r[0]) for _, r in rows)]).tolist()
        blobs = [_packed(local[a:b], count[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([pa.array([-1, *(c for c, _ in rows)], pa.int64()), pa.array([_packed(*sums), *blobs], pa.binary())], ["chunk", "blob"])


def _pair(two: np.ndarray, one: np.ndarray) -> np.ndarray:
    """The hashed feature of both classes before."""
    return (((two * CLASSES + one).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % PAIRS


def _logits(weights: np.ndarray, two: np.ndarray, one: np.ndarray) -> np.ndarray:
    return weights[0] + weights[1 + one] + weights[1 + CLASSES + two] + weights[1 + 2 * CLASSES + _pair(two, one)]


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def _summed(two: np.ndarray, one: np.ndarray, x: np.ndarray) -> np.ndarray:
    """x (contexts x classes), summed for each feature of the contexts."""
    out = np.zeros((1 + 2 * CLASSES + PAIRS, CLASSES))
    out[0] = x.sum(axis=0)
    np.add.at(out, 1 + one, x)
    np.add.at(out, 1 + CLASSES + two, x)
    np.add.at(out, 1 + 2 * CLASSES + _pair(two, one), x)
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Contexts (two before, one before) and their counts of each class."""
    parts = [_unpacked(x) for b in batches for x in b.column("blob").to_pylist()]
    if not parts:
        return None
    key, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    before, row = np.unique(key // CLASSES, return_inverse=True)
    counts = np.zeros((len(before), CLASSES))
    np.add.at(counts, (row, key % CLASSES), n)
    return before // CLASSES, before % CLASSES, counts


def train(triples: DataFrame, updates: int = UPDATES) -> np.ndarray:
    """Weights (features x classes) of the classes' model, from the summed parts of the table of triples, by gradient updates.

    Each update is one job, in which each partition sums the expected counts of its rows' features. The gradient, observed less
    expected counts less the prior's pull, is scaled by the expected counts and the prior, so rare features move little.
    """
    context = triples.sparkSession.sparkContext
    shape = (1 + 2 * CLASSES + PAIRS, CLASSES)

    def gathered(f) -> np.ndarray:
        """The sum of f(two, one, counts) over the partitions: at most PARTS rows of the model's size."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            got = _counted(batches)
            if got:
                yield pa.RecordBatch.from_arrays([pa.array([_summed(got[0], got[1], f(*got)).astype(np.float32).tobytes()], pa.binary())], ["g"])

        out = np.zeros(shape)
        for r in triples.mapInArrow(run, "g binary").collect():
            out += np.frombuffer(r["g"], np.float32).reshape(shape)
        return out

    observed = gathered(lambda two, one, counts: counts)
    weights = np.zeros(shape, np.float32)
    total = observed[0].sum()
    if not total:
        return weights
    weights[0] = np.log((observed[0] + 0.5) / (total + 0.5 * CLASSES))
    for _ in range(updates):
        held = context.broadcast(weights)
        expected = gathered(lambda two, one, counts: counts.sum(axis=1, keepdims=True) * np.exp(_log_softmax(_logits(held.value, two, one).astype(np.float64))))  # noqa: B023
        pull = PRIOR * weights
        pull[0] = 0
        weights = weights + (STEP * (observed - expected - pull) / (expected + PRIOR)).astype(np.float32).clip(-1, 1)
        held.destroy()
    return weights


def class_table(weights: np.ndarray) -> np.ndarray:
    """P(class | two before, one before)."""
    two, one = np.divmod(np.arange(CLASSES * CLASSES), CLASSES)
    p = np.exp(_log_softmax(_logits(weights, two, one).astype(np.float64)))
    p[:, START] = 0  # no token is of that class
    return (p / p.sum(axis=1, keepdims=True)).astype(np.float32).reshape(CLASSES, CLASSES, CLASSES)


class Model:
    """The factors' models: tables of probabilities by class and by group.

    triples: P(class | two classes before); tables: counts of groups after the hashed word before, and after that two before;
    sizes, kinds: training tokens and distinct words of each group.
    """

    def __init__(self, triples: np.ndarray, tables: list[np.ndarray], sizes: np.ndarray, kinds: np.ndarray, ends: int):
        mass = (sizes + kinds + 1.0).reshape(CLASSES, GROUPS)
        mass[END:] = 0
        mass[END:, 0] = ends + 1, 0
        share = mass / np.maximum(mass.sum(axis=1, keepdims=True), 1e-300)
        classes = mass.sum(axis=1) / mass.sum()
        self.triples, self.share = triples, share.ravel().astype(np.float32)
        self.by_class, self.by_group = [], []
        for t in tables:
            n = t.reshape(-1, CLASSES, GROUPS)
            of_class = n.sum(axis=2)
            self.by_class.append(((of_class + DRAW * classes) / (of_class.sum(axis=1, keepdims=True) + DRAW)).astype(np.float32))
            self.by_group.append(((n + DRAW * share) / (of_class[:, :, None] + DRAW)).reshape(len(n), -1).astype(np.float32))
        self.below = np.log10(sizes + kinds + 1.0)
        self.mix = np.full((2, 3), 1 / 3)

    def parts(self, now: np.ndarray, one: np.ndarray, two: np.ndarray, group: np.ndarray, hv: np.ndarray, hu: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of tokens: P(class | before) and P(group | class, before) by each of the mixed models."""
        of_class = np.stack([self.triples[two, one, now], self.by_class[0][hv, now], self.by_class[1][hu, now]])
        return of_class, np.stack([self.share[group], self.by_group[0][hv, group], self.by_group[1][hu, group]])

    def log10(self, steps: tuple[np.ndarray, ...]) -> np.ndarray:
        """Of tokens, log10 of their group's probability."""
        of_class, of_group = self.parts(*steps)
        return np.log10(self.mix[0] @ of_class) + np.log10(self.mix[1] @ of_group)


def _tokens(codes: np.ndarray, lens: np.ndarray, most: int = 1 << 17) -> Iterator[tuple[slice, slice]]:
    """Runs of whole texts of about `most` words: the texts, and their words."""
    ends = np.cumsum(lens)
    a = 0
    while a < len(lens):
        begin = int(ends[a] - lens[a])
        b = max(a + 1, int(np.searchsorted(ends, begin + most)))
        yield slice(a, b), slice(begin, int(ends[min(b, len(lens)) - 1]))
        a = b


def mixed(model: Model, texts: DataFrame, updates: int = MIXES) -> Model:
    """The model with its mixtures trained on the training texts of all chunks: each block of words is learned from in one of the updates.

    An update is one job: partitions add up how likely each of the mixed models is to have made the tokens; the mixture before
    weighs as much as one token.
    """
    context = texts.sparkSession.sparkContext
    for k in range(updates):
        held = context.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m, total = held.value, np.zeros((2, 3))  # noqa: B023
            for batch in batches:
                for blob in batch.column("blob").to_pylist():
                    ids, lens, out, codes = _unpacked(blob)
                    train = np.repeat(out == 0, lens)
                    words, sizes = codes[ids[train]], lens[out == 0].astype(np.int64)
                    for n, (t, w) in enumerate(_tokens(words, sizes, BLOCK)):
                        if n % updates != k:  # noqa: B023
                            continue
                        for j, p in enumerate(m.parts(*_steps(words[w], sizes[t]))):
                            made = m.mix[j][:, None] * p
                            total[j] += (made / made.sum(axis=0)).sum(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in total.ravel()], ["c0", "c1", "c2", "g0", "g1", "g2"])

        found = texts.select("blob").mapInArrow(_tidy(run), "c0 double, c1 double, c2 double, g0 double, g1 double, g2 double")
        total = np.array(found.agg(*[F.sum(c) for c in found.columns]).first(), float).reshape(2, 3)
        total = np.nan_to_num(total) + model.mix
        model.mix = total / total.sum(axis=1, keepdims=True)
        held.destroy()
    return model


def lm_scores(docs: DataFrame, held_out: Column, chunk: int = CHUNK, updates: int = UPDATES) -> DataFrame:
    """One row per row of docs (doc_id, text), all columns of which but these two are ignored.

    doc_id, held_out, n_tokens (words and one end), n_known (of these, in training texts), train_tokens, base_score (log10 of the
    text by smoothed unigrams) and score (log10 of the text by the model). The model learns from rows for which held_out is
    false (a null counts as false). Null and empty texts are an end alone. Texts are read whole; repeated rows come out, and
    count, as often as they go in. Without training rows the base is 0 and the model knows no word. An empty table gives no rows.
    """
    model, n, ends, made, met, chunks = fit(docs, held_out, chunk, updates)
    base = float(np.log10(n + model.words + 1))
    kind = docs.select("doc_id").schema[0].dataType
    held = docs.sparkSession.sparkContext.broadcast(model)  # tables of a fixed number of cells

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by chunk, the counts of each chunk's words before its texts."""
        m, found = held.value, []
        for batch in batches:
            for last, blob, ids_of in zip(batch.column("last").to_pylist(), batch.column("blob").to_pylist(), batch.column("docs"), strict=True):
                if not last:
                    found.append(_unpacked(blob))
                    continue
                ids, lens, out, codes = _unpacked(blob)
                lens = lens.astype(np.int64)
                c = np.zeros(len(codes), np.int64)
                for local, count in found:
                    c[local] = count
                found = []
                for t, w in _tokens(ids, lens):
                    size = lens[t]
                    steps = _steps(codes[ids[w]], size)
                    now, group = steps[0], steps[3]
                    tokens = np.full(len(now), ends, np.int64)
                    tokens[now != END] = c[ids[w]]
                    plain = np.log10(tokens + 1.0)
                    by_model = m.log10(steps) + np.where(now == END, 0.0, plain - m.below[group])
                    first = np.cumsum(size + 1) - size - 1
                    total = lambda x: np.add.reduceat(x, first)  # noqa: E731, B023
                    cols = [
                        ids_of.values[t.start : t.stop], pa.array(out[t] == 1), pa.array(size + 1), pa.array(total((tokens > 0).astype(np.int64))),
                        pa.array(np.full(len(size), n, np.int64)), pa.array(total(plain) - (size + 1) * base), pa.array(total(by_model)),
                    ]
                    yield pa.RecordBatch.from_arrays(cols, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    known = met.where("chunk >= 0").select("chunk", F.lit(False).alias("last"), "blob", F.lit(None).cast(made.schema["docs"].dataType).alias("docs"))
    texts = made.where("kind = 1").select("chunk", F.lit(True).alias("last"), "blob", "docs")
    both = known.unionByName(texts).repartition(max(1, chunks // 2), "chunk").sortWithinPartitions("chunk", "last")
    return both.mapInArrow(_tidy(score), f"doc_id {kind.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def fit(docs: DataFrame, held_out: Column, chunk: int = CHUNK, updates: int = UPDATES) -> tuple[Model, int, int, DataFrame, DataFrame, int]:
    """The model, training tokens, training texts, the tables of chunks and of their words' counts, and the number of chunks."""
    parts = max(16, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))  # of words, by hash
    made = materialise(_chunks(docs, F.coalesce(held_out, F.lit(False)).cast("int"), chunk, parts), "chunks")
    words = made.where("kind = 0").select("chunk", "part", "blob").repartition(parts, "part")
    met = materialise(words.mapInArrow(_tidy(_met), "chunk long, blob binary"), "met")
    counted = made.where("kind >= 2").select("kind", "part", F.shiftrightunsigned("chunk", 32).alias("task"), "blob")
    # sums in a tree: of n tasks the root of n meets in one place, then the sums of these places
    fan = max(1, round((counted.agg(F.max("task")).first()[0] or 0) ** 0.5))
    some = counted.repartition("kind", "part", F.col("task") % fan).mapInArrow(_tidy(_added), "kind int, part int, blob binary")
    tables = some.repartition(len(TABLES) * PARTS, "kind", "part").mapInArrow(_tidy(_added), "kind int, part int, blob binary")
    tables = materialise(tables, "tables")
    sizes, kinds = np.zeros((2, CLASSES * GROUPS), np.int64)
    for r in met.where("chunk = -1").select("blob").collect():  # a row of a fixed size for each part
        x, y = _unpacked(r["blob"])
        sizes, kinds = sizes + x, kinds + y
    whole = [np.zeros(n, np.int64) for n in TABLES[1:]]
    for r in tables.where("kind > 2").collect():  # tables of a fixed number of cells
        at, n = _unpacked(r["blob"])
        whole[r["kind"] - 3][at] = n
    whole = [t.reshape(CLASSES * BEFORE, CLASSES * GROUPS) for t in whole]
    ends = int(whole[0][:, END * GROUPS].sum())
    model = Model(class_table(train(tables.where("kind = 2"), updates)), whole, sizes, kinds, ends)
    model.words = int(kinds.sum()) + (ends > 0)
    chunks = made.where("kind = 1").count()
    model = mixed(model, made.where("kind = 1").select("chunk", "blob"))
    discard(tables)
    return model, int(sizes.sum()) + ends, ends, made, met, chunks
