"""Packing of token sequences: concatenate and cut.

First pass: texts are tokenised where they are read; each row is written with its ids, its number within the task and the
tokens before it in its task. The totals of the tasks (one row each) give global offsets by a prefix sum. Second pass: the
written rows, with their task's offset, are cut wherever the global position is a multiple of the sequence length, and each
piece is a boundary record. No ids are shuffled, and a text is tokenised once.

Whole texts are encoded by tiktoken, from the vocabulary of the tokenizers file, where that file is a plain byte-level BPE whose
ids are its merge ranks (the ids are the same, in a quarter of the time); else by tokenizers. Texts that have the string of an
added token, which stands for its id, or a very long run of white space, over which tiktoken's pattern fails, go to tokenizers.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colophon.llm._common import materialise, small

LENGTH = 2048
#: Fixed value: the public pattern by which byte-level BPE cuts text before merging.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A run of white space that is left to tokenizers, and its length.
RUN = 100_000
_LONG_RUN = re.compile(rf"\s{{{RUN}}}")
_workers: dict[str, _Encoder] = {}


def _ranked(spec: dict):
    """The tiktoken encoding with the same ids as the tokenizers file, if there is one."""
    import tiktoken

    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    if sys.byteorder != "little" or not plain or spec.get("normalizer") or model.get("dropout") or model.get("ignore_merges"):
        return None
    vocab, merges = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if any(vocab.get(a + b) != 256 + k for k, (a, b) in enumerate(merges)):
        return None
    # byte-level letters: printable Latin-1 bytes stand for themselves, the others for letters from 256 on, in order
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letter = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(sorted({*range(256)} - {*own}))}
    special = {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(letter[c] for c in w): i for w, i in vocab.items() if w not in special}
    if {*range(256)} != {i for w, i in ranks.items() if len(w) == 1}:
        return None
    return tiktoken.Encoding("words", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})


class _Encoder:
    """ids of texts as bytes of unsigned 16-bit (or, for large vocabularies, 32-bit) numbers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.path, tokenizer = path, Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        spec = json.loads(tokenizer.to_str())
        self.ranked = _ranked(spec)
        self.tokenizer = None if self.ranked else tokenizer
        added = [t["content"] for t in spec.get("added_tokens", [])]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None

    def _odd(self, text: str) -> bool:
        return bool(self.added and self.added.search(text)) or (len(text) >= RUN and bool(_LONG_RUN.search(text)))

    def _plain(self, texts: list[str]) -> list[bytes]:
        if self.tokenizer is None:  # most workers never need a second one
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(self.path)
        return [np.array(e.ids, self.kind).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.ranked is None:
            return self._plain(texts)
        code, kind = self.ranked.encode_ordinary, "H" if self.kind.itemsize == 2 else "I"
        return [self._plain([t])[0] if self._odd(t) else array(kind, code(t)).tobytes() for t in texts]


def tokenised(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """part, before, doc_id, n, ids: each row's ids with the end id, as little-endian bytes, and where it is in its task."""
    kind = docs.select("doc_id").schema[0].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, before = TaskContext.get().partitionId(), 0
        encoder = _workers.get(tokenizer) or _workers.setdefault(tokenizer, _Encoder(tokenizer))
        end = np.array([end_id], encoder.kind).tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = batch.slice(at, 500)
                ids = [x + end for x in encoder.encode([t or "" for t in rows.column("text").to_pylist()])]
                n = np.array([len(x) // encoder.kind.itemsize for x in ids], np.int64)
                first = before + np.cumsum(n) - n
                before += int(n.sum())
                cols = [pa.array(np.full(len(n), part, np.int32)), pa.array(first), rows.column("doc_id"), pa.array(n), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, ["part", "before", "doc_id", "n", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"part int, before long, doc_id {kind.simpleString()}, n long, ids binary")


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = 1) -> DataFrame:
    """The pieces of all rows of docs (doc_id, text) in sequences of `length` tokens; only the last sequence may be shorter.

    doc_id, start (the row's ids before the piece), length, ids (binary, little-endian unsigned 32-bit), doc_tokens (with the end
    id), sequence_id, offset (in the sequence; the pieces of a sequence leave no gap). tokenizer is the path of a tokenizers
    file on every executor; end_id ends each row. Null and empty texts give the end id alone. Repeated rows are packed as
    often as they come; ids may be null; other columns are ignored; an empty table gives no rows. Texts are never cut short, and
    the string of an added token is that token.
    """
    from tokenizers import Tokenizer

    narrow = Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 and end_id < 1 << 16
    rows = materialise(tokenised(docs, tokenizer, end_id), "tokens")
    totals = rows.groupBy("part").agg(F.max(F.col("before") + F.col("n")).alias("total"))
    # one row for each task of the first pass
    base = F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = small(materialise(totals.select("part", base.alias("base")), "offsets"))
    kind = docs.select("doc_id").schema[0].dataType
    stored = np.dtype("<u2" if narrow else "<u4")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                first, n = batch.column("first").to_numpy(), batch.column("n").to_numpy()
                pieces = (first + n - 1) // length - first // length + 1
                row = np.repeat(np.arange(len(n)), pieces)
                k = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                sequence = first[row] // length + k
                start = np.maximum(first[row], sequence * length)
                stop = np.minimum(first[row] + n[row], (sequence + 1) * length)
                own = start - first[row]
                ids = [np.frombuffer(x, stored).astype("<u4") for x in batch.column("ids").to_pylist()]
                cells = [ids[r][a : a + b].tobytes() for r, a, b in zip(row.tolist(), own.tolist(), (stop - start).tolist(), strict=True)]
                cols = [batch.column("doc_id").take(pa.array(row)), pa.array(own), pa.array(stop - start), pa.array(cells, pa.binary()), pa.array(n[row]), pa.array(sequence), pa.array(start - sequence * length)]
                yield pa.RecordBatch.from_arrays(cols, names)

    placed = rows.join(offsets, "part").select("doc_id", (F.col("base") + F.col("before")).alias("first"), "n", "ids")
    return placed.mapInArrow(cut, f"doc_id {kind.simpleString()}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
