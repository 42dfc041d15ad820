"""Substring deduplication by sliding spans of sentences."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import in_batches, keyed, stored

#: Consecutive sentences in a span, and the words it has at least.
SENTENCES, WORDS = 3, 25
#: Sentences count as several: they are cut after the word with the least hash of every run of
#: CUT words, so that no piece is longer. Such cuts depend on the words around only: in a run of 50
#: equal words all but the outer CUT - 1 are cut alike, and hold a whole span wherever it begins:
#: it starts by word 2 * CUT - 1, has WORDS by CUT - 1 more, and 2 * (2 * CUT - 1) + WORDS - 1 <= 50.
CUT = 7
ROWS_OUT = 50_000

# Scripts without blanks between words (Thai to Khmer, kana, Han); each character counts as a word.
_BARE = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF))
_IS_BARE = np.zeros(0xFB01, bool)
for _low, _high in _BARE:
    _IS_BARE[_low : _high + 1] = True
_IS_SPACE = np.array([chr(c).isspace() for c in range(0x3001)] + [False])
_UNIT = re.compile("[{0}]|[^\\s{0}]+".format("".join(f"{chr(low)}-{chr(high)}" for low, high in _BARE)))


def lowered(text: str) -> str:
    """In lower case, character by character where the whole would change its length."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def words_of(text: str) -> list[str]:
    """Words in lower case; characters where there are no blanks."""
    return _UNIT.findall(lowered(text))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Two independent hashes of words: each letter's is multiplied with its place's.
_PLACES = 1 << 16
_SEEDS = (0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F)
_OF_PLACE = [mixed(np.arange(1, _PLACES + 1, dtype=np.uint64) * np.uint64(s)) for s in _SEEDS]


def at_place(of_place: np.ndarray, places: np.ndarray) -> np.ndarray:
    return of_place[places % _PLACES] * (2 * (places // _PLACES) + 1).astype(np.uint64)


def of_words(letters: np.ndarray, first: np.ndarray, lane: int) -> np.ndarray:
    """Hashes of the words that begin at ``first``, from the hashes of their letters in a row."""
    place = np.arange(len(letters)) - np.repeat(first, np.diff(first, append=len(letters)))
    return mixed(np.add.reduceat(letters * at_place(_OF_PLACE[lane], place), first))


def winnowed(hashes: np.ndarray) -> np.ndarray:
    """Places of the least hash, the first of equals, of every CUT words in a row."""
    if len(hashes) < CUT:
        return np.zeros(0, np.int64)
    least = np.lib.stride_tricks.sliding_window_view(hashes, CUT).argmin(axis=1)
    return np.unique(least + np.arange(len(least)))


def cut(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(borders of the pieces, from 0 to the end; hashes of letters; first letter and piece of each word).

    Pieces are sentences, which end with their marks or a line and the blanks after it, cut
    again where their words say.
    """
    points = np.frombuffer(lowered(text).encode("utf-32-le", "surrogatepass"), "<u4")
    solid = np.flatnonzero(~_IS_SPACE[np.minimum(points, len(_IS_SPACE) - 1)])
    n = len(points)
    if not len(solid):
        return np.array([0, n] if n else [0]), np.zeros(0, np.uint64), np.zeros((0, 2), np.int64)
    own = points[solid]
    mark = (own == ord(".")) | (own == ord("!")) | (own == ord("?"))
    bare = _IS_BARE[np.minimum(own, len(_IS_BARE) - 1)] & (own < len(_IS_BARE))
    lines = np.cumsum(points == 10)[solid]
    apart = solid[1:] > solid[:-1] + 1
    ends = np.where(apart, mark[:-1] | (lines[1:] > lines[:-1]), mark[:-1] & ~mark[1:])
    new = np.concatenate([[True], apart | bare[1:] | bare[:-1]])
    letters = mixed(own.astype(np.uint64) + np.uint64(1))
    unit = np.flatnonzero(new)
    after = winnowed(of_words(letters, unit, 0)) + 1
    sentence = np.concatenate([[lines[0] > 0], ends])
    borders = np.concatenate([[0], solid[sentence], solid[unit[after[after < len(unit)]]], [n]])
    borders = np.unique(borders)
    first = np.flatnonzero(new | np.concatenate([[False], ends]))
    return borders, letters, np.stack([first, np.searchsorted(borders, solid[first], "right") - 1], axis=1)


def sentences(text: str) -> list[str]:
    """The text in pieces that join to it again."""
    borders = cut(text)[0].tolist()
    return [text[a:b] for a, b in zip(borders, borders[1:])]


def spans(pieces: list[str]) -> Iterator[tuple[int, int, str]]:
    """(first, number, normal form) of the shortest span from each sentence on that is long enough.

    The last of them comes once more up to the end, so that no sentence is in none.
    ``hashed_spans`` finds the same by hash; this says what they are.
    """
    words = [words_of(p) for p in pieces]
    filled = [i for i, w in enumerate(words) if w]

    def span(k: int, end: int) -> tuple[int, int, str]:
        return filled[k], filled[end - 1] - filled[k] + 1, " ".join(w for j in filled[k:end] for w in words[j])

    end = total = 0
    for k, i in enumerate(filled):
        while end < len(filled) and (end - k < SENTENCES or total < WORDS):
            total += len(words[filled[end]])
            end += 1
        if end - k < SENTENCES or total < WORDS:
            if k and before < len(filled):
                yield span(k - 1, len(filled))
            return
        yield span(k, end)
        before = end
        total -= len(words[i])


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(lane: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of a lane's seed, and of its inverse modulo 2 to the 64th."""
    if lane not in _POWERS or len(_POWERS[lane][0]) < n:
        size = max(_PLACES, 2 * n)
        bases = (_SEEDS[lane], pow(_SEEDS[lane], -1, 1 << 64))
        _POWERS[lane] = tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, b, np.uint64)])) for b in bases)
    up, down = _POWERS[lane]
    return up[:n], down[:n]


def hashed_spans(text: str) -> tuple[int, list[np.ndarray]]:
    """The number of pieces, and (hash, more, start, length) of every span, by characters."""
    borders, letters, words = cut(text)
    of_piece = np.bincount(words[:, 1], minlength=len(borders) - 1)
    filled = np.flatnonzero(of_piece)
    upto = np.concatenate([[0], np.cumsum(of_piece[filled])])
    end = np.maximum(np.arange(len(filled)) + SENTENCES, np.searchsorted(upto, upto[:-1] + WORDS))
    end = end[end <= len(filled)]  # ends never fall
    k = np.arange(len(end))
    if not len(k):
        return len(borders) - 1, []
    if end[-1] < len(filled):
        k, end = np.append(k, k[-1]), np.append(end, len(filled))
    hashes = []
    for lane in (0, 1):
        up, down = powers(lane, len(words) + 1)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(of_words(letters, words[:, 0], lane) * up[:-1])])
        hashes.append(mixed((sums[upto[end]] - sums[upto[k]]) * down[upto[k]]))
    more = (hashes[1] >> np.uint64(32)).astype(np.uint32).view(np.int32)
    start = borders[filled[k]]
    return len(borders) - 1, [hashes[0].view(np.int64), more, start, borders[filled[end - 1] + 1] - start]


#: A row without hash has the number of a text's pieces as its length.
SPAN = "key long, hash long, more int, start int, length int"


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
    names = ["key", "hash", "more", "start", "length"]

    def out(found: list[list[np.ndarray]]) -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*found)]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    for batch in batches:
        keys, pieces, found, size = batch.column("key").to_pylist(), [], [], 0
        for key, text in zip(keys, batch.column("text")):
            n, columns = hashed_spans(text.as_py())
            pieces.append(n)
            if columns:
                found.append([np.full(len(columns[0]), key), *columns])
                size += len(columns[0])
            if size >= ROWS_OUT:
                yield out(found)
                found, size = [], 0
        if found:
            yield out(found)
        none = [pa.nulls(len(keys), k) for k in kinds[1:3]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, kinds[0]), *none, pa.array([0] * len(keys), kinds[3]), pa.array(pieces, kinds[4])], names
        )


CLEANED = "doc_id long, n_sentences long, n_removed long, text string"


def without(text: str, start: np.ndarray, end: np.ndarray) -> tuple[int, str]:
    """(pieces removed, text left) when the spans found are taken out; they may overlap."""
    order = np.argsort(start, kind="stable")
    start, upto = start[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.concatenate([[True], start[1:] > upto[:-1]]))
    low, high = start[new], upto[np.append(new[1:], len(upto)) - 1]
    borders = cut(text)[0]
    removed = int((np.searchsorted(borders, high) - np.searchsorted(borders, low)).sum())
    kept = [text[a:b] for a, b in zip([0, *high.tolist()], [*low.tolist(), len(text)])]
    return removed, "".join(kept)


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = batch.column("found")
        spans, upto = found.flatten(), np.append(0, np.cumsum(found.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))
        start, length = (spans.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("start", "length"))
        removed, kept = [], []
        for text, a, b in zip(batch.column("text").to_pylist(), upto.tolist(), upto[1:].tolist()):
            n, left = without(text, start[a:b], start[a:b] + length[a:b]) if a < b else (0, text)
            removed.append(n)
            kept.append(left)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_sentences"), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
            ["doc_id", "n_sentences", "n_removed", "text"],
        )


def remove_repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, n_sentences, n_removed, text) for every row of ``docs`` (doc_id, text, ...).

    From every sentence on, the shortest span of SENTENCES or more consecutive sentences with
    WORDS or more words is hashed (96 bits, case and white space aside); sentences count as
    several (CUT). Every repeated run of 50 words holds a span; up to 2 * CUT - 1 words at each end
    of it may stay, unless the text ends there. All spans meet by hash. The first occurrence, by document and place, stays;
    sentences in any later one are removed, in the same document too. Counts and firsts are
    aggregated before the shuffle; the join back to places reads stored tables on both sides,
    so that a span found everywhere is split.

    Null and empty texts give an empty text and no sentence; texts shorter than a span stay.
    Repeated rows are repeats of each other: the first stays. A null doc_id stays null; other
    columns are ignored.
    """
    rows = keyed(docs, "spans-rows")
    every = stored(in_batches(rows.select("key", "text"), _spans, SPAN), "spans-all", "zstd")
    hashed = every.where("hash is not null")
    firsts = hashed.groupBy("hash", "more").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("key", "start")).alias("first"))
    repeated = stored(
        firsts.where("times > 1").select("hash", "more", F.col("first.key").alias("first_key"), F.col("first.start").alias("first_start")),
        "spans-repeated",
    )
    later = hashed.join(repeated, ["hash", "more"]).where("key <> first_key or start <> first_start")
    found = later.select("key", F.struct("start", "length").alias("span"), F.lit(None).cast("long").alias("n"))
    pieces = every.where("hash is null").select("key", F.lit(None).cast(found.schema["span"].dataType), F.col("length").cast("long"))
    by_text = stored(found.union(pieces), "spans-later", "zstd").groupBy("key").agg(
        F.collect_list("span").alias("found"), F.max("n").alias("n_sentences")
    )
    return in_batches(rows.join(by_text, "key").select("doc_id", "text", "found", "n_sentences"), _clean, CLEANED)
