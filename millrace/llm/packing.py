"""Packing along a space-filling curve: similar documents share sequences."""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm.shared import in_batches, stored

VOCABULARY = "byte_bpe_50k"
SPECIAL = "<|endoftext|>"
SEPARATOR = 1
LENGTH = 2048

#: Hashed document vectors, their projection, and the grid of the curve.
VECTOR, DIMENSIONS, GRID_BITS = 64, 3, 10
#: Pieces of text whose ids a worker keeps at hand.
KEPT_PIECES = 200_000
#: Rows of the second pass per Arrow batch out.
ROWS_OUT = 5_000


class Pieces(dict):
    """ids of a space and a piece of text without one, packed; forgotten when there are too many."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= KEPT_PIECES:
            self.clear()
        self[piece] = packed = np.array(self.encode(" " + piece), "<u2").tobytes()
        return packed


class TextIds:
    """ids of whole texts as the tokenizer file has them.

    The vocabulary's pattern never crosses the border before a lone space that a visible
    character follows, so the pieces between such spaces are encoded apart and remembered.
    Texts with other spaces are encoded whole, those that spell the special token by the
    tokenizer that gives it its own id.
    """

    _odd = re.compile(r" \s| \Z")

    def __init__(self, ranks_path: str, json_path: str):
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        coder = tiktoken.Encoding("ids", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.encode = coder.encode_ordinary
        self.pieces = Pieces(self.encode)
        self.json_path = json_path

    @cached_property
    def whole(self) -> Tokenizer:
        return Tokenizer.from_file(self.json_path)

    def __call__(self, text: str) -> np.ndarray:
        if SPECIAL in text:
            ids = self.whole.encode(text, add_special_tokens=False).ids
        elif self._odd.search(text):
            ids = self.encode(text)
        else:
            first, *rest = text.split(" ")
            return np.concatenate(
                [np.array(self.encode(first), "<u2"), np.frombuffer(b"".join(map(self.pieces.__getitem__, rest)), "<u2")]
            )
        return np.array(ids, "<u2")


@lru_cache(maxsize=2)
def text_ids(vocabulary: str) -> TextIds:
    return TextIds(public_tokenizers.path(f"{vocabulary}.tiktoken"), public_tokenizers.path(f"{vocabulary}.json"))


@lru_cache(maxsize=1)
def _hashing() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each id its place and sign in the vector, and the projection's orthonormal rows."""
    mixed = np.arange(1 << 16, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    place = (mixed >> np.uint64(58)).astype(np.int64)
    sign = 1.0 - 2.0 * ((mixed >> np.uint64(40)) & np.uint64(1)).astype(np.float64)
    axes = np.linalg.qr(np.random.default_rng(7).normal(size=(VECTOR, DIMENSIONS)))[0]
    return place, sign, axes


def document_point(ids: np.ndarray) -> np.ndarray:
    """The document's hashed vector, of length one, on few axes: numbers from -1 to 1."""
    place, sign, axes = _hashing()
    vector = np.bincount(place[ids], weights=sign[ids], minlength=VECTOR)
    length = np.sqrt(vector @ vector)
    return (vector / length if length else vector) @ axes


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Places along the Hilbert curve of integer grid points (n, dimensions), after Skilling (2004)."""
    x = [points[:, k].astype(np.int64) for k in range(points.shape[1])]
    for b in range(bits - 1, 0, -1):
        q, low = 1 << b, (1 << b) - 1
        for i in range(len(x)):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[0]
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> b) & 1, (1 << b) - 1, 0)
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for axis in x:
            key = key << 1 | ((axis ^ flip) >> b) & 1
    return key


def grid(points: np.ndarray) -> np.ndarray:
    """Coordinates spread by about 1/8 around 0 on the whole grid."""
    cells = 1 << GRID_BITS
    return np.clip((points + 0.5) * cells, 0, cells - 1).astype(np.int64)


def _encoder(vocabulary: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = text_ids(vocabulary)
        for batch in batches:
            ids = [np.append(ids_of(t.as_py() or ""), np.uint16(SEPARATOR)) for t in batch.column("text")]
            points = np.array([document_point(i) for i in ids]).reshape(-1, DIMENSIONS)
            keys = hilbert_keys(grid(points), GRID_BITS)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(keys, pa.int64()), pa.array([len(i) for i in ids], pa.int64()),
                 pa.array([i.tobytes() for i in ids], pa.binary())],
                ["doc_id", "curve", "doc_tokens", "ids"],
            )

    return encode


def powers_of_two(tokens: int) -> list[int]:
    """The last sequence's tokens as sequences that need no padding."""
    return [1 << b for b in range(tokens.bit_length() - 1, -1, -1) if tokens >> b & 1]


class Cutter:
    """Cuts the documents of a partition, one after another, into sequences."""

    def __init__(self, first_sequence: int, length: int):
        self.sequence, self.length = first_sequence, length
        self.held: list[tuple] = []  # (doc_id, start, ids, doc_tokens) of the sequence begun
        self.filled = 0
        self.rows: list[tuple] = []

    def _emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, doc_tokens in pieces:
            crc = zlib.crc32(ids.astype("<u4").tobytes())
            self.rows.append((doc_id, start, len(ids), crc, doc_tokens, self.sequence, offset))
            offset += len(ids)
        self.sequence += 1

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        start = 0
        while start < len(ids):
            part = ids[start : start + self.length - self.filled]
            self.held.append((doc_id, start, part, len(ids)))
            self.filled += len(part)
            start += len(part)
            if self.filled == self.length:
                self._emit(self.held)
                self.held, self.filled = [], 0

    def finish(self) -> None:
        for size in powers_of_two(self.filled):
            own = []
            while size:
                doc_id, start, ids, doc_tokens = self.held.pop(0)
                own.append((doc_id, start, ids[:size], doc_tokens))
                if len(ids) > size:
                    self.held.insert(0, (doc_id, start + size, ids[size:], doc_tokens))
                size -= min(size, len(ids))
            self._emit(own)
        self.filled = 0


PIECES = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def _cutter(length: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter(TaskContext.get().partitionId() << 40, length)

        def out() -> pa.RecordBatch:
            columns = list(zip(*cutter.rows)) or [()] * len(PIECES)
            cutter.rows = []
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], list(PIECES))

        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id"), batch.column("ids")):
                cutter.add(doc_id.as_py(), np.frombuffer(ids.as_buffer(), "<u2"))
                if len(cutter.rows) >= ROWS_OUT:
                    yield out()
        cutter.finish()
        yield out()

    return cut


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, length: int = LENGTH) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every document becomes its ids and a separator. Its hashed vector is projected to three
    axes; the place of that point on a Hilbert curve is its sort key. Documents are sorted by
    range of (key, doc_id), so that a large group of copies is split over partitions, and each
    partition is cut from end to end into full sequences. The tokens left at its end make
    sequences whose lengths are powers of two. Nothing is padded. Ids are stored once, between
    the two passes, in the shared folder.

    Null and empty texts are the separator alone. Repeated rows are packed each for itself,
    a null doc_id stays null, other columns are ignored, an empty table has no pieces.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    encoded = stored(
        in_batches(rows, _encoder(vocabulary), "doc_id long, curve long, doc_tokens long, ids binary"), "packing-ids"
    )
    order = ("curve", "doc_id", "doc_tokens")
    along = encoded.repartitionByRange(*order).sortWithinPartitions(*order)
    return in_batches(along.select("doc_id", "ids"), _cutter(length), ", ".join(f"{c} long" for c in PIECES))
