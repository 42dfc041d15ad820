"""Spelling variants: words one edit apart, by search schemes over FM-indexes of the vocabulary.

One edit leaves one half of a word as it is. Words are dealt out by their halves, so that a
shard holds every word that begins (or ends) like the words it looks for. In a shard's
bidirectional index of the delimited words a search matches the delimiter and the whole half
and goes on across the other half with one error, to the closing delimiter: from the left half
to the right by the BWT of the reversed text, from the right half to the left by the other.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.fm_index import DELIMITER, Bwt, bwt_of
from millrace.llm.shared import in_batches, stored, whole_text

LETTERS = "a-zÀ-ÿ"  # after A-Z are lower-cased
LEAST_LENGTH = 6
LEAST_COUNT = 5
TIMES = 5  # a form is so many times as frequent
TYPO = 199  # one run in so many loses a letter
#: Rows (a word under one of its halves) of a shard; a half with more is dealt to several shards.
SHARD_ROWS = 1 << 17
#: Words searched at once, characters of a text cut into words at once, words counted at once.
BLOCK = 1 << 14
TEXT_BLOCK = 1 << 20
COUNTED = 1 << 19

_RUN = re.compile(f"[{LETTERS}]{{{LEAST_LENGTH},}}")
_GAP = re.compile(f"[^{LETTERS}]")


def runs(text: str) -> Iterator[Counter]:
    """Counts of the runs of LEAST_LENGTH letters or more, for parts of the text; no run is cut."""
    lowered, start = text.encode().lower().decode(), 0  # bytes: lower-cases A-Z only
    while start < len(lowered):
        gap = _GAP.search(lowered, start + TEXT_BLOCK)
        end = gap.end() if gap else len(lowered)
        yield Counter(_RUN.findall(lowered[start:end]))
        start = end


def spelt(run: str, doc: int) -> str:
    """The run as its document spells it; ``doc`` is the CRC-32 of what precedes the run."""
    h = zlib.crc32(run.encode(), doc)
    if h % TYPO:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: Counter = Counter()

    def out() -> pa.RecordBatch:
        words = pa.array(found.keys(), pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(found.values(), pa.int64())], ["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            doc = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            for part in runs(text.as_py()):
                for run, n in part.items():
                    word = spelt(run, doc)
                    if len(word) >= LEAST_LENGTH:
                        found[word] += n
                if len(found) >= COUNTED:
                    yield out()
                    found.clear()
    yield out()


def vocabulary(docs: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words with ``least`` occurrences, stored. They are counted where they are read."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    counts = in_batches(texts, _counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return stored(counts.where(F.col("n") >= least), "spelling-words")


def halved(words: DataFrame) -> DataFrame:
    """(word, side, half, asks): each word under the halves by which words one edit away look for it.

    A word of m letters looks by its first m / 2 and by the rest; those looking for it have one
    letter less, as many, or one more.
    """
    m = F.length("word")
    sizes = F.array(m - 1, m, m + 1)

    def under(side: str, own, lengths):
        at = F.array_distinct(lengths)
        half = (lambda k: F.substring("word", F.lit(1), k)) if side == "first" else (lambda k: F.substring("word", m - k + 1, k))
        return F.transform(at, lambda k: F.struct(F.lit(side).alias("side"), half(k).alias("half"), (k == own).alias("asks")))

    first, last = F.floor(m / 2).cast("int"), F.ceil(m / 2).cast("int")
    both = F.concat(
        under("first", first, F.transform(sizes, lambda k: F.floor(k / 2).cast("int"))),
        under("last", last, F.transform(sizes, lambda k: F.ceil(k / 2).cast("int"))),
    )
    return words.select("word", F.explode(both).alias("at")).select("word", "at.*")


def dealt(words: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(shard, side, word, asks, held): rows of ``halved`` by shard.

    The words under a half with more than ``shard_rows`` are held in parts, and whoever looks by
    that half asks every part.
    """
    rows = halved(words)
    hot = rows.groupBy("side", "half").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > shard_rows)
    hot = stored(hot.select("side", "half", F.ceil(F.col("rows") / shard_rows).cast("int").alias("parts")), "spelling-hot")
    shards = max(1, -(-rows.count() // shard_rows))
    if hot.isEmpty():
        spread = rows.withColumn("part", F.lit(0)).withColumn("held", F.lit(True))
    else:
        own = F.pmod(F.xxhash64("word"), F.coalesce("parts", F.lit(1)))
        to = F.when(F.col("asks") & F.col("parts").isNotNull(), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(own.cast("int")))
        spread = rows.join(hot, ["side", "half"], "left").withColumn("part", F.explode(to)).withColumn("held", F.col("part") == own)
    shard = F.pmod(F.xxhash64("side", "half", "part"), F.lit(shards))
    return spread.select(shard.alias("shard"), "side", "word", "asks", "held")


def repeat_each(values: list[np.ndarray], times: np.ndarray) -> list[np.ndarray]:
    return [np.repeat(v, times) for v in values]


class Vocabulary:
    """The index of a shard's words, different from each other."""

    def __init__(self, words: list[str]):
        text = "\0" + "".join(w + "\0" for w in words)
        self.alphabet, codes = np.unique(np.frombuffer(text.encode("utf-32-le"), "<u4"), return_inverse=True)
        self.delimiters = np.flatnonzero(codes == DELIMITER)
        depth = max(map(len, words), default=0) + 2
        self.last = len(codes) - 1
        self.bwt, self.order = {}, {}
        for side, symbols in (("first", codes[::-1]), ("last", codes)):
            bwt, self.order[side] = bwt_of(symbols, depth)
            self.bwt[side] = Bwt(bwt)

    def word_at(self, side: str, ranks: np.ndarray) -> np.ndarray:
        """Numbers of the words whose delimited text has these suffix ranks."""
        at = self.order[side][ranks]
        if side == "last":
            return np.searchsorted(self.delimiters, at)
        return np.searchsorted(self.delimiters, self.last - at) - 1

    def near(self, side: str, asked: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number in ``asked``, number of the word) of words one edit away in the other half; some come twice."""
        spelt = [w if side == "first" else w[::-1] for w in asked]
        sizes = np.array([len(w) for w in spelt], np.int64)
        offsets = np.cumsum(sizes) - sizes
        points = np.frombuffer("".join(spelt).encode("utf-32-le"), "<u4")
        # Letters that no word of the shard has are given a symbol that is found nowhere.
        pattern = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        pattern = np.where(self.alphabet[pattern] == points, pattern, len(self.alphabet))
        half = sizes // 2 if side == "first" else sizes - sizes // 2
        bwt = self.bwt[side]

        q = np.arange(len(spelt))
        lo, hi = np.zeros(len(q), np.int64), np.full(len(q), len(self.delimiters))
        for t in range(int(half.max(initial=0))):
            on = half[q] > t
            lo[on], hi[on] = bwt.step(lo[on], hi[on], pattern[offsets[q[on]] + t])
            q, lo, hi = (x[lo < hi] for x in (q, lo, hi))

        at = half[q]
        wrong = tuple(np.zeros(0, np.int64) for _ in range(4))  # with an error: asked, place, interval
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while len(q) or len(wrong[0]):
            wq, wat, wlo, whi = wrong
            ended = wat == sizes[wq]
            symbol = np.where(ended, DELIMITER, pattern[np.minimum(offsets[wq] + wat, len(pattern) - 1)])
            wlo, whi = bwt.step(wlo, whi, symbol)
            hit = wlo < whi
            found.append((wq[hit & ended], self.word_at(side, wlo[hit & ended])))
            more = [tuple(x[hit & ~ended] for x in (wq, wat + 1, wlo, whi))]

            ended = at == sizes[q]
            symbol = np.where(ended, DELIMITER, pattern[np.minimum(offsets[q] + at, len(pattern) - 1)])
            following = np.where(at + 1 < sizes[q], pattern[np.minimum(offsets[q] + at + 1, len(pattern) - 1)], -1)
            drop = ~ended & (symbol != following)  # of equal letters in a row the last is left out
            more.append(tuple(x[drop] for x in (q, at + 1, lo, hi)))

            # All symbols that come next, once for each different interval.
            intervals, which = np.unique(lo * (bwt.n + 1) + hi, return_inverse=True)
            ilo, ihi = intervals // (bwt.n + 1), intervals % (bwt.n + 1)
            owner, child, count = bwt.children(ilo, ihi - ilo)
            clo = bwt.rank(child, ilo[owner])
            number = np.bincount(owner, minlength=len(intervals))
            start = np.cumsum(number) - number
            times = number[which]
            cq, cat, cstart, csymbol, cended = repeat_each([q, at, start[which], symbol, ended], times)
            nth = cstart + np.arange(len(cq)) - np.repeat(np.cumsum(times) - times, times)
            other = (child[nth] != DELIMITER) & (child[nth] != csymbol)
            cq, cat, nth, cended = (x[other] for x in (cq, cat, nth, cended))
            inserted = (cq, cat, clo[nth], clo[nth] + count[nth])
            more += [inserted, tuple(x[~cended] for x in (cq, cat + 1, *inserted[2:]))]

            q, at, lo, hi, symbol = (x[~ended] for x in (q, at, lo, hi, symbol))
            lo, hi = bwt.step(lo, hi, symbol)
            q, at, lo, hi = (x[lo < hi] for x in (q, at + 1, lo, hi))
            wrong = tuple(np.concatenate(x) for x in zip(*more))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found))


def _near(shard: pa.Table) -> pa.Table:
    held = shard.filter(shard.column("held")).column("word").unique().to_pylist()
    asking = shard.filter(shard.column("asks"))
    out = []
    if held:
        index, names = Vocabulary(held), pa.array(held, pa.string())
        for side in ("first", "last"):
            asked = asking.filter(pa.compute.equal(asking.column("side"), side)).column("word").unique()
            for start in range(0, len(asked), BLOCK):
                block = asked[start : start + BLOCK]
                a, b = index.near(side, block.to_pylist())
                out.append(pa.table({"word": block.take(pa.array(a)), "near": names.take(pa.array(b))}))
    none = pa.table({"word": pa.array([], pa.string()), "near": pa.array([], pa.string())})
    return pa.concat_tables([none, *out])


def near_words(words: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(word, near): all pairs of ``words`` one inserted, deleted or replaced letter apart, in both orders."""
    rows = dealt(words, shard_rows)
    return stored(rows.groupBy("shard").applyInArrow(_near, "word string, near string").distinct(), "spelling-near")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each chain of ``forms`` (word, form), which has no circle.

    Every round follows twice as many steps as the one before.
    """
    at = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if at.join(onward, "root", "left_semi").isEmpty():
            return at
        at = stored(at.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "spelling-roots")


def variants(docs: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every word of ``docs`` (doc_id, text, ...).

    Words are the runs of letters after the rule of TYPO, with LEAST_LENGTH letters and
    LEAST_COUNT occurrences. ``form`` is the near word with most occurrences (ties: the first in
    the order of code points) if it has TIMES as many, ``root`` the end of the chain of forms.
    Null texts count as empty, a null doc_id as the empty string; repeated rows count again, other columns are
    ignored, an empty table gives no row.
    """
    words = vocabulary(docs)
    counts = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = near_words(words, shard_rows).join(counts, "near").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    judged = words.join(best, "word", "left")
    is_form = -F.col("best.less") >= TIMES * F.col("n")
    judged = stored(
        judged.select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n"),
        ),
        "spelling-forms",
    )
    ends = roots(judged.where("form is not null"))
    return judged.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word")).select("word", "n", "n_near", "form", "form_n", "root")
