"""Exact copies by two-pass Bloom filtering: only rows whose hash may be repeated are shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import stored, whole_row, whole_text

BITS_PER_ROW = 16
HASHES = 3  # bits of a hash, all in one 64-bit word of the filter
#: Words of a filter that is broadcast, some 24 bytes each; a larger one is joined by shuffles.
MOST_WORDS = 1 << 21


def text_digest() -> Column:
    """SHA-256 of the text with each run of white space as one space; null counts as empty."""
    return F.unhex(F.sha2(F.regexp_replace(whole_text(), r"[\x20\x09-\x0D]+", " "), 256))


def hashed(docs: DataFrame, *columns: Column) -> DataFrame:
    """``columns``, doc_id, the text's digest, and a 64-bit hash of that."""
    rows = docs.select(*columns, F.col("doc_id").cast("long").alias("doc_id"), text_digest().alias("digest"))
    return rows.withColumn("hash", F.xxhash64("digest"))


def bits() -> list[Column]:
    return [F.shiftrightunsigned("hash", 40 + 6 * k).bitwiseAND(F.lit(63)) for k in range(HASHES)]


def one_bit(number: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), number.cast("int"))


def words_for(rows: int) -> int:
    """64-bit words of a filter for so many rows, a power of two."""
    return 1 << max(4, (rows * BITS_PER_ROW // 64).bit_length())


def twice_set(rows: DataFrame, words: int) -> DataFrame:
    """Pass one: the filter's words (word, twice), with the bits that two or more rows set.

    Rows are counted by word and bit before the shuffle, so a hash that a third of all rows
    share leaves each task as a few counts. Words without such a bit are not there.
    """
    word = F.col("hash").bitwiseAND(F.lit(words - 1)).alias("word")
    each = rows.select(word, F.explode(F.array_distinct(F.array(*bits()))).alias("bit"))
    twice = each.groupBy("word", "bit").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return twice.groupBy("word").agg(F.bit_or(one_bit(F.col("bit"))).alias("twice"))


def with_repeats(rows: DataFrame, seen: DataFrame, words: int) -> DataFrame:
    """Pass two: ``rows`` with ``may_repeat``, true for every hash that two or more rows have.

    It is true for few others. The filter is broadcast up to MOST_WORDS words; beyond that the
    rows are joined with it by shuffle, with the same result.
    """
    small = seen.count() <= MOST_WORDS
    mask = one_bit(bits()[0])
    for b in bits()[1:]:
        mask = mask.bitwiseOR(one_bit(b))
    keyed = rows.withColumn("word", F.col("hash").bitwiseAND(F.lit(words - 1)))
    found = keyed.join(F.broadcast(seen) if small else seen, "word", "left")
    may = F.coalesce(F.col("twice").bitwiseAND(mask) == mask, F.lit(False))
    return found.withColumn("may_repeat", may).drop("word", "twice")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs`` (doc_id, text, ...).

    Texts are equal if they are identical once each run of white space is one space; null counts
    as empty. Of equal texts the row with the smallest doc_id stays, a row without one only where
    no row has one; of rows with that same id just one. Other columns are ignored, an empty table
    gives an empty one. Digests and ids are stored; the texts are read once and never shuffled.
    """
    rows = stored(hashed(docs, F.monotonically_increasing_id().alias("row")), "exact-digests")
    words = words_for(rows.count())
    judged = with_repeats(rows, stored(twice_set(rows, words), "exact-filter"), words)
    alone = judged.where("not may_repeat").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest"
    )
    repeated = judged.where("may_repeat")
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row")
    groups = repeated.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), F.min(order).alias("first"))
    groups = stored(groups, "exact-groups")
    several = repeated.join(groups, "digest").select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("first.row")).alias("kept"), "digest"
    )
    every = alone.unionByName(several)
    return every.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; rows that cannot repeat are not shuffled."""
    rows = hashed(docs, whole_row(docs).alias("row"))
    words = words_for(docs.count())
    judged = with_repeats(rows, stored(twice_set(rows, words), "exact-filter"), words)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"))
    firsts = judged.where("may_repeat").groupBy("digest").agg(F.min_by("row", order).alias("row"))
    return judged.where("not may_repeat").select("row.*").unionByName(firsts.select("row.*"))
