"""Removal of byte strings that occur twice or more: winnowed anchors meet by hash, texts around them are compared."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import in_batches, keyed, stored

#: Strings of this many bytes are removed wherever they occur twice or more.
LENGTH = 400
#: Bytes that a cover sample looks at.
GRAM = 100
#: Positions of a text that are sampled in one go; bounds memory for very long texts.
STEP = 1 << 19
#: Blocks of more occurrences than this are compared by way of hashed windows.
HOT = 4096
#: Different contexts of a block that are compared pair by pair.
FEW = 12
#: Contexts of hot blocks taken together, and windows in one bucket of theirs.
SLICE, BUCKET = 1000, 2_000_000
#: Window records settled together; a context of very many places is settled in parts.
MOST_RECORDS = 1_000_000
#: Rows per Arrow batch out.
ROWS_OUT = 20_000


# -- window hashes ------------------------------------------------------------------------


@lru_cache(maxsize=2)
def _tables(which: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number per byte value, powers of an odd base modulo 2**64, and their inverses."""
    rng = np.random.default_rng(400 + which)
    values = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
    base = int(rng.integers(1, 1 << 62)) * 8 + 5
    size = STEP + LENGTH + 1

    def powers(of: int) -> np.ndarray:
        out = np.full(size, of % (1 << 64), np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return values, powers(base), powers(pow(base, -1, 1 << 64))


def window_hashes(text: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """A 64-bit hash of every ``width`` bytes of ``text``, equal for equal strings."""
    values, up, down = _tables(which)
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(values[text] * up[: len(text)], out=sums[1:])
    hashes = (sums[width:] - sums[:-width]) * down[: len(text) - width + 1]
    hashes ^= hashes >> np.uint64(31)
    hashes *= np.uint64(0x9E3779B97F4A7C15)
    hashes ^= hashes >> np.uint64(29)
    return hashes


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, from running minima of blocks in both directions."""
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    table = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(table, axis=1).ravel()
    backward = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - width + 1
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n])


def cover_sample(text: np.ndarray) -> tuple[np.ndarray, ...]:
    """(hash, position, first, last): the sample, and the windows of LENGTH bytes each covers.

    A window is covered by the gram in it with the least hash, the leftmost of equals. Two
    equal windows therefore have their sample at the same offset, which is what a difference
    cover is for, while only one position in 150 is sampled. ``first`` and ``last`` are
    starts of windows; every window has one sample.
    """
    low = np.uint64((1 << 20) - 1)
    found = []
    for start in range(0, len(text) - LENGTH + 1, STEP):
        part = text[start : start + STEP + LENGTH - 1]
        hashes = window_hashes(part, GRAM)
        order = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
        at = (sliding_min(order, LENGTH - GRAM + 1) & low).astype(np.int64)
        change = np.flatnonzero(np.diff(at)) + 1
        first = np.concatenate([[0], change])
        last = np.concatenate([change - 1, [len(at) - 1]])
        found.append((hashes[at[first]].view(np.int64), at[first] + start, first + start, last + start))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(c) for c in zip(*found))


def _samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "hash", "at", "first", "last"]
    for batch in batches:
        held, rows = [], 0
        for key, text in zip(batch.column("key"), batch.column("text").cast(pa.binary())):
            columns = cover_sample(np.frombuffer(text.as_buffer(), np.uint8))
            held.append((np.full(len(columns[0]), key.as_py()), *columns))
            rows += len(columns[0])
            if rows >= ROWS_OUT:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names)
                held, rows = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names)


# -- the contexts of sampled grams that occur twice or more ---------------------------------


CONTEXT = "hash long, n long, left int, context binary, key long, firsts binary"


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each sample with the bytes of all its windows; equal ones of a text are one row."""
    for batch in batches:
        rows: dict[str, list] = {c: [] for c in ("hash", "n", "left", "context", "key", "firsts")}

        def out() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.binary())
            made = pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), kinds)], list(rows))
            for v in rows.values():
                v.clear()
            return made

        texts = batch.column("text").cast(pa.binary())
        for key, text, hits in zip(batch.column("key"), texts, batch.column("hits")):
            data, same = text.as_py(), {}
            for hash_, n, at, first, last in zip(*(hits.values.field(k).to_pylist() for k in range(5))):
                context = data[first : last + LENGTH]
                same.setdefault((hash_, n, at - first, context), []).append(first)
            for (hash_, n, left, context), firsts in same.items():
                for column, value in zip(rows.values(), (hash_, n, left, context, key.as_py(), np.array(firsts, "<i4").tobytes())):
                    column.append(value)
            if len(rows["key"]) >= ROWS_OUT // 4:
                yield out()
        yield out()


def common(a: bytes, b: bytes, from_end: bool) -> int:
    """How many bytes two strings share at their starts, or at their ends."""
    n = min(len(a), len(b))
    a, b = (a[len(a) - n :], b[len(b) - n :]) if from_end else (a[:n], b[:n])
    if a == b:
        return n
    differ = np.flatnonzero(np.frombuffer(a, np.uint8) != np.frombuffer(b, np.uint8))
    return int(n - 1 - differ[-1] if from_end else differ[0])


def _pairwise(contexts: list[tuple[int, bytes]]) -> list[list[tuple[int, int]]]:
    """For each (left, context) the runs of window starts in it that another one shares."""
    found: list[list[tuple[int, int]]] = [[] for _ in contexts]
    for i, (left, own) in enumerate(contexts):
        for j, (other_left, other) in enumerate(contexts[:i]):
            before = common(own[:left], other[:other_left], True)
            after = common(own[left:], other[other_left:], False)
            least = max(0, LENGTH - after)
            if least <= before:
                found[i].append((left - before, left - least))
                found[j].append((other_left - before, other_left - least))
    return found


def _runs(marks: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
    return [(int(a), int(b) - 1) for a, b in zip(edges[::2], edges[1::2])]


def _by_hash(contexts: list[tuple[int, bytes]]) -> list[list[tuple[int, int]]]:
    """As _pairwise, by sorting the hashes of all windows."""
    own = [_window_pairs(context) for _, context in contexts]
    sizes = [len(h) for h in own]
    hashes = np.concatenate(own)
    repeated = _repeated(hashes)
    return [_runs(r) for r in np.split(repeated, np.cumsum(sizes)[:-1])]


def _window_pairs(context: bytes) -> np.ndarray:
    """Two hashes of every window, as one record."""
    data = np.frombuffer(context, np.uint8)
    pairs = np.empty(len(data) - LENGTH + 1, [("h", "<u8"), ("g", "<u8")])
    pairs["h"], pairs["g"] = window_hashes(data, LENGTH, 0), window_hashes(data, LENGTH, 1)
    return pairs


def _repeated(pairs: np.ndarray) -> np.ndarray:
    order = np.lexsort((pairs["g"], pairs["h"]))
    ordered = pairs[order]
    equal = ordered[1:] == ordered[:-1]
    marks = np.zeros(len(pairs), bool)
    marks[order[1:]] = equal
    marks[order[:-1]] |= equal
    return marks


def shared_windows(rows: list[tuple[int, bytes, int]]) -> list[list[tuple[int, int]]]:
    """For each (left, context, times) of a block, the runs of window starts that occur elsewhere."""
    places: dict[tuple[int, bytes], list[int]] = {}
    for i, (left, context, _) in enumerate(rows):
        places.setdefault((left, context), []).append(i)
    different = list(places)
    found = (_pairwise if len(different) <= FEW else _by_hash)(different) if len(different) > 1 else [[]]
    out: list[list[tuple[int, int]]] = [[] for _ in rows]
    for (left, context), runs in zip(different, found):
        own = places[left, context]
        if sum(rows[i][2] for i in own) > 1:
            runs = [(0, len(context) - LENGTH)]
        for i in own:
            out[i] = runs
    return out


FOUND = "key long, ranges binary"


def _ranges(firsts: bytes, runs: list[tuple[int, int]]) -> bytes:
    """Bytes to remove, (from, to) pairs, for every place of a context."""
    at = np.frombuffer(firsts, "<i4").astype(np.int64)
    pairs = [np.stack([at + a, at + b + LENGTH], axis=1) for a, b in runs]
    return np.concatenate(pairs).astype("<i8").tobytes()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares one block at a time: the rows of one hash, which come one after another."""
    held: list[tuple] = []
    out: list[tuple[int, bytes]] = []

    def settle() -> None:
        found = shared_windows([(left, context, len(firsts) // 4) for left, context, _, firsts in held])
        for (_, _, key, firsts), runs in zip(held, found):
            if runs:
                out.append((key, _ranges(firsts, runs)))
        held.clear()

    def batch_out() -> pa.RecordBatch:
        keys, ranges = zip(*out) if out else ((), ())
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(ranges, pa.binary())], ["key", "ranges"])

    current = None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("hash", "left", "context", "key", "firsts")]
        for hash_, *row in zip(*columns):
            if hash_ != current:
                settle()
                current = hash_
                if len(out) >= ROWS_OUT:
                    yield batch_out()
            held.append(tuple(row))
    settle()
    yield batch_out()


# -- hot blocks: windows by hash, repeats in a slice settled at once -----------------------


def _window_records(buckets: int):
    kind = [("h", "<u8"), ("g", "<u8"), ("key", "<i8"), ("start", "<i8")]

    def settle(parts: list[np.ndarray]) -> pa.RecordBatch:
        records = np.concatenate(parts)
        twice = _repeated(records[["h", "g"]])
        rows = [(-1, r) for r in _by_key(records[twice])]
        # Of those settled here one goes on, without a place, to meet its equals elsewhere.
        _, one = np.unique(records[twice][["h", "g"]], return_index=True)
        seen = records[twice][one]
        seen["key"] = seen["start"] = -1
        onward = np.concatenate([records[~twice], seen])
        bucket = onward["h"] % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        rows += [(b, onward[order[cuts[b] : cuts[b + 1]]].tobytes()) for b in range(buckets) if cuts[b] < cuts[b + 1]]
        return pa.RecordBatch.from_arrays(
            [pa.array([b for b, _ in rows], pa.int64()), pa.array([r for _, r in rows], pa.binary())], ["bucket", "records"]
        )

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                parts, held = [], 0
                for context, key, firsts in zip(*(batch.column(c).to_pylist() for c in ("context", "key", "firsts"))):
                    pairs = _window_pairs(context)
                    # A very long text may hold one context at any number of places.
                    for first in np.frombuffer(firsts, "<i4"):
                        part = np.empty(len(pairs), kind)
                        part["h"], part["g"], part["key"] = pairs["h"], pairs["g"], key
                        part["start"] = first + np.arange(len(pairs))
                        parts.append(part)
                        held += len(part)
                        if held >= MOST_RECORDS:
                            yield settle(parts)
                            parts, held = [], 0
                if parts:
                    yield settle(parts)

    return emit


_RECORD = np.dtype([("h", "<u8"), ("g", "<u8"), ("key", "<i8"), ("start", "<i8")])


def _by_key(records: np.ndarray) -> list[bytes]:
    """The records' (key, start) pairs, one string for each key."""
    if not len(records):
        return []
    ordered = records[np.lexsort((records["start"], records["key"]))]
    pairs = np.stack([ordered["key"], ordered["start"]], axis=1)
    return [p.tobytes() for p in np.split(pairs, np.flatnonzero(np.diff(ordered["key"])) + 1)]


def _found_rows(strings: list[bytes]) -> pa.RecordBatch:
    keys, ranges = [], []
    for s in strings:
        pairs = np.frombuffer(s, "<i8").reshape(-1, 2)
        keys.append(int(pairs[0, 0]))
        starts = pairs[:, 1]
        breaks = np.flatnonzero(np.diff(starts) > 1)
        low = starts[np.concatenate([[0], breaks + 1])]
        high = starts[np.concatenate([breaks, [len(starts) - 1]])]
        ranges.append(np.stack([low, high + LENGTH], axis=1).astype("<i8").tobytes())
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(ranges, pa.binary())], ["key", "ranges"])


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _found_rows(batch.column("records").to_pylist())


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorts one bucket of hashed windows at a time."""
    held: list[bytes] = []
    current = None

    def settle() -> pa.RecordBatch:
        records = np.frombuffer(b"".join(held), _RECORD)
        held.clear()
        again = records[_repeated(records[["h", "g"]])] if len(records) else records
        return _found_rows(_by_key(again[again["key"] != -1]) if len(again) else [])

    for batch in batches:
        for bucket, records in zip(batch.column("bucket").to_pylist(), batch.column("records").to_pylist()):
            if bucket != current:
                yield settle()
                current = bucket
            held.append(records)
    yield settle()


# -- removal ---------------------------------------------------------------------------------


def kept_bytes(data: bytes, ranges: list[bytes]) -> tuple[bytes, int, int]:
    """What is left of ``data``, how many bytes go, and in how many maximal runs."""
    if not ranges:
        return data, 0, 0
    pairs = np.frombuffer(b"".join(ranges), "<i8").reshape(-1, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    upto = np.maximum.accumulate(pairs[:, 1])
    new = np.concatenate([[True], pairs[1:, 0] > upto[:-1]])
    low = pairs[new, 0]
    high = upto[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(pairs) - 1]])]
    borders = [0, *(int(x) for pair in zip(low, high) for x in pair), len(data)]
    kept = b"".join(data[a:b] for a, b in zip(borders[::2], borders[1::2]))
    return kept, len(data) - len(kept), len(low)


REMOVED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        cut = [kept_bytes(t, r or []) for t, r in zip(texts, batch.column("found").to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([n for _, n, _ in cut], pa.int64()),
                pa.array([s for _, _, s in cut], pa.int64()),
                pa.array([k for k, _, _ in cut], pa.binary()),
            ],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) for every row of ``docs`` (doc_id, text, ...).

    Every byte is removed that lies in a string of LENGTH bytes which starts anywhere else too,
    in the same text or another, overlaps included; ``kept`` is what remains.

    Of each text's positions a sample is taken by content, and the strings there are counted by
    hash; only samples whose hash occurs twice or more go on. Positions with such a sample form a
    block, whatever their text, with the bytes around it as context. No suffixes are sorted: equal
    contexts are one, others are compared to both sides of the sample, whose shared hash settles
    the bytes between. Blocks with more than HOT occurrences are dealt out as hashed windows: a slice
    settles its own repeats and sends on each different window once, so that no string,
    however frequent, meets in one task in all its copies.

    Null and empty texts and those shorter than LENGTH lose nothing; rows that repeat are
    repeats of each other; a null doc_id stays null; other columns are ignored; an empty table
    gives an empty one.
    """
    rows = keyed(docs, "suffix-rows")
    texts = rows.select("key", "text")
    samples = stored(
        in_batches(texts, _samples, "key long, hash long, at long, first long, last long"), "suffix-samples"
    )
    ranks = stored(samples.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "suffix-ranks")
    hits = samples.join(ranks, "hash").groupBy("key").agg(
        F.collect_list(F.struct("hash", "n", "at", "first", "last")).alias("hits")
    )
    contexts = stored(in_batches(texts.join(hits, "key"), _contexts, CONTEXT), "suffix-contexts")
    cold = contexts.where(F.col("n") <= HOT).select("hash", "left", "context", "key", "firsts")
    found = in_batches(cold.repartition("hash").sortWithinPartitions("hash"), _blocks, FOUND)
    hot = ranks.where(F.col("n") > HOT).agg(F.sum("n").alias("n")).first()["n"]
    if hot:
        buckets = -(-hot * (LENGTH - GRAM) // BUCKET)
        own = contexts.where(F.col("n") > HOT).select("context", "key", "firsts")
        windows = stored(in_batches(own, _window_records(buckets), "bucket long, records binary"), "suffix-windows")
        at_once = windows.where("bucket < 0").mapInArrow(_settled, FOUND)
        onward = windows.where("bucket >= 0").repartition("bucket").sortWithinPartitions("bucket")
        found = found.union(at_once).union(in_batches(onward, _buckets, FOUND))
    by_text = stored(found, "suffix-found").groupBy("key").agg(F.collect_list("ranges").alias("found"))
    return in_batches(rows.join(by_text, "key", "left").select("doc_id", "text", "found"), _remove, REMOVED)
