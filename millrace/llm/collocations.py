"""Phrases whose words occur together more often than apart, from FM-indexes over word ids.

Texts are cut into shards of some two and a half million words where they are read. Each shard is one
FM-index (``fm_index``) and is stored; its phrases are enumerated by extending BWT intervals to
the left and to the right. Counts are summed across shards one length at a time where that
prunes: words, then pairs of frequent words, then triples of frequent pairs, then all longer
phrases of frequent triples. What is frequent comes back to a shard by a join on the shard, so nothing is broadcast.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.fm_index import DELIMITER, Bidirectional, Phrases, bwt_of, shallow_order
from millrace.llm.shared import in_batches, shuffles_removed, stored, whole_text

LONGEST = 5
LEAST = 100
PERCENT = 100  # a phrase inside a longer one that has so much of its count is dropped
TOP = 2000
#: Words of a shard: its index takes some 30 bytes for each while it is made.
SHARD_WORDS = 5 << 19
#: Enough for the different words of a shard; beyond them 20 bits number a task's shards, 20 the task.
SYMBOL_BITS = 23
#: Bytes of a text that are split into words at once, and words of all languages that are turned into numbers at once.
BLOCK = 1 << 18
CODED = 1 << 17
#: Different words of a shard that are handed over in one row.
WORDS_A_ROW = 1 << 14
#: Ends a piece: bytes that no UTF-8 text has.
END = b"\xff"
_MARKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", END * 10)
_BREAK = re.compile(rb"[\x20\x09-\x0D.,;:!?]")

SHARD = "shard long, n long, leftward binary, rightward binary, outside array<int>, first int, words array<struct<lang: string, word: string, n: long>>"
ROW = pa.schema(
    [("shard", pa.int64()), ("n", pa.int64()), ("leftward", pa.binary()), ("rightward", pa.binary()), ("outside", pa.list_(pa.int32())), ("first", pa.int32()),
     ("words", pa.list_(pa.struct([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])))]
)


def blocks(text: bytes) -> Iterator[bytes]:
    """The text in parts of about BLOCK bytes; no word is cut."""
    start = 0
    while start < len(text):
        cut = _BREAK.search(text, start + BLOCK)
        end = cut.end() if cut else len(text)
        yield text[start:end]
        start = end


def tokens(part: bytes) -> list[bytes]:
    """Words, A-Z lower-cased, with END between pieces."""
    return part.lower().translate(_MARKS).replace(END, b" " + END + b" ").split()


def packed(symbols: np.ndarray) -> bytes:
    """Symbols as compressed planes of bytes; most are small numbers."""
    return pa.compress(symbols.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4")[:, 0]


class Words:
    """One language's words of a shard as numbers; END is 0."""

    def __init__(self, carried: list[bytes] = ()):
        self.coded, self.fresh = [pa.array([END], pa.binary()).dictionary_encode()], list(carried)

    def code(self) -> None:
        self.coded.append(pa.array(self.fresh, pa.binary()).dictionary_encode())
        self.fresh = []

    def text(self) -> pa.DictionaryArray:
        """All words so far; the first entry of the dictionary is END."""
        self.code()
        one = pa.chunked_array(self.coded).unify_dictionaries().combine_chunks()
        self.coded = [one]
        return one.slice(1)

    def last(self, n: int) -> list[bytes]:
        text = self.text()
        return text.slice(max(0, len(text) - n)).to_pylist()


def indexed(shard: int, of_lang: dict[str, Words], open_lang: str | None) -> Iterator[pa.RecordBatch]:
    """A row of SHARD with the index, then rows with the words. Empties ``of_lang``.

    Of ``open_lang`` the last words are only context; the next shard counts them.
    """
    parts, listed, known, size, outside = [np.zeros(1, np.int32)], [], 0, 1, range(0)
    for lang in sorted(of_lang):
        words = of_lang.pop(lang).text()
        codes, names = words.indices.to_numpy().copy(), words.dictionary.slice(1)
        if lang == open_lang:
            outside = range(size + max(0, len(codes) - LONGEST + 1), size + len(codes))
        codes[codes > 0] += known
        parts += [codes, np.zeros(1, np.int32)]
        listed.append((lang, names))
        known += len(names)
        size += len(codes) + 1
        del words, codes
    text = np.concatenate(parts)
    del parts
    counts = np.bincount(text, minlength=known + 1) - np.bincount(text[outside.start : outside.stop], minlength=known + 1)
    left, order = bwt_of(text, LONGEST, shallow_order)
    context = np.flatnonzero((order >= outside.start) & (order < outside.stop))
    del order
    left = packed(left)
    right = packed(bwt_of(text[::-1], LONGEST, shallow_order)[0])
    yield one_row(shard=shard, n=size, leftward=left, rightward=right, outside=pa.array(context, pa.int32()))
    del left, right, text
    at = 1
    for lang, names in listed:
        for start in range(0, len(names), WORDS_A_ROW):
            some = names.slice(start, WORDS_A_ROW)
            n = pa.array(counts[at : at + len(some)], pa.int64())
            fields = [pa.repeat(pa.scalar(lang, pa.string()), len(some)), some.cast(pa.string()), n]
            yield one_row(shard=shard, first=at, words=pa.StructArray.from_arrays(fields, ["lang", "word", "n"]))
            at += len(some)


def one_row(**values) -> pa.RecordBatch:
    """A row of SHARD; what is not named is null."""
    arrays = []
    for field in ROW:
        value = values.get(field.name)
        arrays.append(pa.ListArray.from_arrays([0, len(value)], value) if isinstance(value, pa.Array) else pa.array([value], field.type))
    return pa.RecordBatch.from_arrays(arrays, ROW.names)


def _shards(batches: Iterator[pa.RecordBatch], shard_words: int) -> Iterator[pa.RecordBatch]:
    number, size, waiting = TaskContext.get().partitionId() << 20, 0, 0
    of_lang: dict[str, Words] = defaultdict(Words)
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary())):
            for part in blocks(text.as_py()):
                found = tokens(part)
                of_lang[lang].fresh += found
                size += len(found)
                waiting += len(found)
                if waiting >= CODED:
                    for words in of_lang.values():
                        words.code()
                    waiting = 0
                if size >= shard_words:
                    del found
                    carried = of_lang[lang].last(LONGEST - 1)
                    yield from indexed(number, of_lang, lang)
                    pa.default_memory_pool().release_unused()
                    of_lang[lang] = Words(carried)
                    number, size, waiting = number + 1, len(carried), len(carried)
            of_lang[lang].fresh.append(END)
    if size:
        yield from indexed(number, of_lang, None)


def among(ascending: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys are in an ascending array that is not empty."""
    return ascending[np.minimum(np.searchsorted(ascending, keys), len(ascending) - 1)] == keys


class Shard:
    """Row ``i`` of a batch of stored shards: its index, with the frequent words' numbers."""

    def __init__(self, batch: pa.RecordBatch, i: int):
        row = batch.slice(i, 1)
        one = lambda c: row.column(c)[0].as_py()
        sides = [unpacked(one(c), one("n")) for c in ("leftward", "rightward") if c in batch.schema.names]
        self.index = Bidirectional(*sides)
        self.number = one("shard")
        self.outside = row.column("outside").flatten().to_numpy().astype(np.int64)
        self.symbols, self.ids = self.listed(row, "known", ("symbol", "id"))
        self.width = int(self.index.left.bwt.max(initial=0)) + 1
        self.id_of = np.full(self.width, -1, np.int64)
        self.id_of[self.symbols] = self.ids
        alive = batch.schema.field("alive").type.value_type if "alive" in batch.schema.names else ()
        self.alive = self.listed(row, "alive", tuple(f.name for f in alive)) if alive else None

    @staticmethod
    def listed(row: pa.RecordBatch, column: str, fields: tuple[str, str]) -> list[np.ndarray]:
        items = row.column(column).flatten()
        return [items.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in fields]

    def counts(self, phrases: Phrases) -> np.ndarray:
        """Occurrences, without those that begin in another shard's words."""
        return phrases.size - np.searchsorted(self.outside, phrases.left + phrases.size) + np.searchsorted(self.outside, phrases.left)

    def frequent_words(self) -> Phrases:
        words = self.index.words()
        return words.where(self.id_of[words.symbols[:, 0]] >= 0)

    def pairs(self, among: np.ndarray | None = None) -> Iterator[Phrases]:
        """Pairs of frequent words, some at a time; ``among``: only those that end with one of these symbols."""
        words = self.frequent_words()
        if among is not None:
            words = words.where(np.isin(words.symbols[:, 0], among))
        for some in words.blocks():
            found = self.index.extended(some, to_the_left=True)
            yield found.where(self.id_of[found.symbols[:, 0]] >= 0)

    def alive_symbols(self) -> list[np.ndarray]:
        """Of the phrases alive, each place's symbols."""
        order = np.argsort(self.ids)
        return [self.symbols[order[np.searchsorted(self.ids, ids, sorter=order)]] for ids in self.alive]

    def triples(self) -> Iterator[Phrases]:
        """Phrases of three words, both pairs in them alive."""
        a, b = self.alive_symbols()
        alive = np.sort(a * self.width + b)
        for found in self.pairs():
            for at in (0, 1):
                if at == 1:
                    found = self.index.extended(found, to_the_left=False)
                found = found.where(among(alive, found.symbols[:, at] * self.width + found.symbols[:, at + 1]))
            yield found

    def longer(self) -> Iterator[Phrases]:
        """Phrases of more than three words, all triples in them alive, one length after another."""
        a, b, c = self.alive_symbols()
        firsts = np.unique(a * self.width + b)
        alive = np.sort(np.searchsorted(firsts, a * self.width + b) * self.width + c)

        def is_alive(phrases: Phrases, at: int) -> np.ndarray:
            a, b, c = phrases.symbols[:, at : at + 3].T
            pair = a * self.width + b
            return among(firsts, pair) & among(alive, np.searchsorted(firsts, pair) * self.width + c)

        for found in self.pairs(np.unique(b)):
            phrases = found.where(among(firsts, found.symbols[:, 0] * self.width + found.symbols[:, 1]))
            for length in range(3, LONGEST + 1):
                to_the_left = length % 2 == 0
                phrases = self.index.extended(phrases, to_the_left)
                phrases = phrases.where(is_alive(phrases, 0 if to_the_left else length - 3))
                if length > 3:
                    yield phrases


def _counted(shard: Shard, phrases: Iterator[Phrases], names: str) -> Iterator[pa.RecordBatch]:
    """Rows of the shard, a column of ids for each of ``names``, and the count."""
    for found in phrases:
        ids, n = shard.id_of[found.symbols], shard.counts(found)
        arrays = [np.full(len(n), shard.number), *map(np.ascontiguousarray, ids.T), n]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in arrays], ["shard", *names, "n"])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            shard = Shard(batch, i)
            yield from _counted(shard, shard.pairs(), "ab")
            del shard
            pa.default_memory_pool().release_unused()


def _triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            shard = Shard(batch, i)
            yield from _counted(shard, shard.triples(), "abc")
            del shard
            pa.default_memory_pool().release_unused()


def _longer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            shard = Shard(batch, i)
            for found in shard.longer():
                m, length = found.symbols.shape
                ids = pa.ListArray.from_arrays(np.arange(m + 1, dtype=np.int32) * length, shard.id_of[found.symbols].ravel())
                yield pa.RecordBatch.from_arrays([ids, pa.array(shard.counts(found))], ["ids", "n"])


def shards(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The stored indexes of all texts. Null text: empty; null language: ``und``."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), whole_text().alias("text"))
    return stored(in_batches(texts, lambda batches: _shards(batches, shard_words), SHARD), "phrases-shards")


def frequent_words(found: DataFrame, least: int) -> DataFrame:
    """(shard, symbol, lang, word, f, id) of the words with ``least`` occurrences in their language, stored.

    A word comes once for each shard that has it; with the same shuffle its total and its number,
    the first shard's for it, go back to each of them.
    """
    local = found.select("shard", "first", F.posexplode("words").alias("at", "w"))
    local = local.select("shard", (F.col("first") + F.col("at")).alias("symbol"), "w.*")
    same = Window.partitionBy("lang", "word")
    first = F.col("shard") * (1 << SYMBOL_BITS) + F.col("symbol")
    total = local.select("shard", "symbol", "lang", "word", F.sum("n").over(same).alias("f"), F.min(first).over(same).alias("id"))
    return stored(total.where(F.col("f") >= least), "phrases-local-words")


def everywhere(local: DataFrame, names: list[str], least: int, purpose: str) -> DataFrame:
    """(shard, *names, f) of phrases with ``least`` occurrences in all shards, stored.

    As with words: a phrase comes once for each shard that has it, and its total goes back to each.
    """
    total = F.sum("n").over(Window.partitionBy(*names)).alias("f")
    return stored(local.select("shard", *names, total).where(F.col("f") >= least), purpose)


def with_alive(indexes: DataFrame, phrases: DataFrame) -> DataFrame:
    """Indexes of the shards that have any of the phrases, each with its own of them."""
    names = [c for c in phrases.columns if c not in ("shard", "f")]
    return indexes.join(phrases.groupBy("shard").agg(F.collect_list(F.struct(*names)).alias("alive")), "shard")


def frequent_phrases(found: DataFrame, local: DataFrame, words: DataFrame, least: int) -> DataFrame:
    """(ids, f) of all phrases of 1 to LONGEST words with ``least`` occurrences, stored."""
    known = stored(local.groupBy("shard").agg(F.collect_list(F.struct("symbol", "id")).alias("known")), "phrases-known")
    indexes = found.where("leftward IS NOT NULL").drop("first", "words").join(known, "shard")
    pairs = in_batches(indexes.drop("rightward"), _pairs, "shard long, a long, b long, n long")
    pairs = everywhere(pairs, ["a", "b"], least, "phrases-pairs")
    triples = in_batches(with_alive(indexes, pairs), _triples, "shard long, a long, b long, c long, n long")
    triples = everywhere(triples, ["a", "b", "c"], least, "phrases-triples")
    longer = in_batches(with_alive(indexes, triples), _longer, "ids array<long>, n long")
    longer = longer.groupBy("ids").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    single = words.select(F.array("id").alias("ids"), "f")
    two, three = (
        found.groupBy(*names).agg(F.first("f").alias("f")).select(F.array(*names).alias("ids"), "f")
        for found, names in ((pairs, "ab"), (triples, "abc"))
    )
    return stored(single.unionByName(two).unionByName(three).unionByName(longer), "phrases-frequent")


def scored(phrases: DataFrame, words: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the candidates that no longer one stands for."""
    several = phrases.where(F.size("ids") > 1)
    parts = several.where(F.size("ids") > 2).select(
        "f", F.explode(F.expr("array(slice(ids, 1, size(ids) - 1), slice(ids, 2, size(ids) - 1))")).alias("ids")
    )
    inside = parts.groupBy("ids").agg(F.max("f").alias("of_longer"))
    kept = several.join(inside, "ids", "left").where(F.coalesce(100 * F.col("of_longer") < percent * F.col("f"), F.lit(True)))
    kept = kept.select("ids", F.col("f").alias("a"))

    texts = kept.select("ids", F.posexplode("ids").alias("at", "id")).join(words.select("id", "lang", "word"), "id")
    texts = texts.groupBy("ids").agg(F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("at", "word"))).alias("w"))
    texts = texts.select("ids", "lang", F.concat_ws(" ", "w.word").alias("phrase"))

    cuts = kept.select("ids", "a", F.explode(F.expr("sequence(1, size(ids) - 1)")).alias("k"))
    first = phrases.select(F.col("ids").alias("first"), F.col("f").alias("l"))
    rest = phrases.select(F.col("ids").alias("rest"), F.col("f").alias("r"))
    cuts = cuts.withColumn("first", F.expr("slice(ids, 1, k)")).withColumn("rest", F.expr("slice(ids, k + 1, size(ids))"))
    counted = cuts.join(first, "first").join(rest, "rest").join(texts, "ids").join(sizes, "lang")
    exact = {c: F.col(c).cast("decimal(20,0)").alias(c) for c in "alrn"}
    counted = counted.withColumn("over", F.lit(1000) * exact["a"] * exact["n"]).withColumn("under", exact["l"] * exact["r"])
    lowest = counted.groupBy("ids").agg(
        F.first("lang").alias("lang"), F.first("phrase").alias("phrase"), F.first("a").alias("a"), F.first("n").alias("n"),
        F.min(F.struct(F.expr("over div under").alias("score"), "k", "l", "r")).alias("cut"),
    )
    return lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations(
    docs: DataFrame, least: int = LEAST, percent: int = PERCENT, top: int = TOP, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of every language of ``docs`` (text, lang, ...).

    A phrase is 2 to LONGEST words of one piece, A-Z lower-cased, with ``least`` or more
    occurrences. Its score is that of its weakest cut. A phrase inside a longer one that has
    ``percent`` of its occurrences is dropped. Null texts count as empty, a null language as
    ``und``; repeated rows count again; doc_id and other columns are not used. No text, or no
    phrase that is frequent enough, gives no row.
    """
    with shuffles_removed(docs.sparkSession):
        found = shards(docs, shard_words)
        local = frequent_words(found, least)
        words = stored(local.groupBy("id").agg(*(F.first(c).alias(c) for c in ("lang", "word", "f"))), "phrases-words")
        sizes = stored(found.select(F.explode("words").alias("w")).groupBy("w.lang").agg(F.sum("w.n").alias("n")), "phrases-sizes")
        phrases = frequent_phrases(found, local, words, least)
    listed = scored(phrases, words, sizes, percent)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = listed.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
