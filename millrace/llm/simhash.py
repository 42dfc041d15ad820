"""SimHash near-duplicates, found by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import components, in_batches, stored, whole_row

BITS = 64
SHINGLE = 3
SEED = 42
#: Shingle hashes whose bits are summed at once; bounds memory for very long texts.
BLOCK = 1 << 16


def simhash(text: bytes) -> int:
    """Bit b is 1 if it is set in over half of the shingles' hashes; no word gives 0."""
    words = text.lower().split()  # bytes: lower-cases A-Z only, splits at \x20 and \x09-\x0D
    if not words:
        return 0
    shingles = zip(*(words[i:] for i in range(SHINGLE))) if len(words) >= SHINGLE else [words]
    hashes = (xxhash.xxh64_intdigest(b" ".join(s), SEED) for s in shingles)
    ones, n = np.zeros(BITS, np.int64), max(1, len(words) - SHINGLE + 1)
    for start in range(0, n, BLOCK):
        block = np.fromiter(hashes, "<u8", min(BLOCK, n - start))
        bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def _simhashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        prints = pa.array((simhash(t.as_py() or b"") for t in texts), pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), prints], ["doc_id", "print"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, print) per row; ``print`` is the fingerprint as a signed long. Null text: 0."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return in_batches(rows, _simhashes, "doc_id long, print long")


def digits(column: str) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def ball(column: str, radius: int) -> Column:
    """All values within ``radius`` differing bits of a long, itself included."""
    values = F.array(F.col(column))
    if radius >= 1:
        flips = [F.lit(1 << b if b < 63 else -(1 << 63)) for b in range(BITS)]
        values = F.concat(values, F.array(*(F.col(column).bitwiseXOR(f) for f in flips)))
    if radius >= 2:
        raise ValueError("balls of radius 2 and more are not emitted")
    return values


def links(prints: DataFrame, distance: int = 2) -> DataFrame:
    """(a, b) pairs of different fingerprints that connect all within ``distance`` bits.

    Every distinct fingerprint emits the ball of half the distance; two fingerprints within
    the distance share a member of their balls. At even distances all that meet at a value
    are within the distance of each other, at most 65 of them, so linking each with the
    smallest loses no connection; each pair is verified by its differing bits.
    """
    if distance not in (0, 2):
        raise ValueError("the distance is twice the radius of a ball: 0 or 2")
    emitted = prints.select("print").distinct().select(
        "print", F.explode(ball("print", distance // 2)).alias("variant")
    )
    smallest = F.min("print").over(Window.partitionBy("variant"))
    return (
        emitted.select("print", smallest.alias("a"))
        .where("print <> a")
        .select("a", F.col("print").alias("b"))
        .distinct()
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    )


def near_duplicates(docs: DataFrame, distance: int = 2) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs`` (doc_id, text, ...).

    component_id is the smallest doc_id that can be reached over links of fingerprints with
    ``distance`` or fewer differing bits, itself included. Null and empty texts, and texts of
    white space, have fingerprint zero and are linked like any other. Repeated rows give
    repeated rows. A null doc_id takes part but never names a component. Extra columns are
    ignored; an empty table gives an empty one. Copies are one fingerprint from the start,
    so that no group of them is ever expanded.
    """
    prints = stored(fingerprints(docs), "simhash-prints")
    firsts = stored(
        prints.groupBy("print").agg(F.min("doc_id").alias("first")), "simhash-firsts"
    )
    member = components(links(firsts, distance), "simhash")
    named = stored(
        firsts.join(member, firsts["print"] == member["node"], "left").select(
            "print", "first", F.coalesce("component", "print").alias("component")
        ),
        "simhash-named",
    )
    lowest = stored(
        named.groupBy("component").agg(F.min("first").alias("component_id")), "simhash-lowest"
    )
    by_print = stored(
        named.join(lowest, "component").select("print", "component_id"), "simhash-components"
    )
    return prints.join(by_print, "print").select(
        "doc_id",
        digits("print").alias("fingerprint"),
        "component_id",
    )


def one_per_group(docs: DataFrame, distance: int = 2) -> DataFrame:
    """The rows of ``docs`` with each component's smallest doc_id, once each; all columns stay.

    Rows without doc_id stay only where nobody in their component has one, one of each fingerprint.
    The ids that go are joined, so that a short list of them leaves the texts where they are;
    texts are only shuffled to drop repeated rows of one id, and only those.
    """
    groups = stored(near_duplicates(docs, distance), "simhash-groups")
    rows = docs.select(whole_row(docs).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    of_id = groups.where("doc_id is not null").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("rows"), F.min(F.col("doc_id") == F.col("component_id")).alias("stays")
    )
    of_id = stored(of_id.where("rows > 1 or not stays"), "simhash-ids")
    going, repeated = of_id.where("not stays").select("doc_id"), of_id.where("stays").select("doc_id")
    named = rows.where("doc_id is not null").join(going, "doc_id", "left_anti")
    if not repeated.isEmpty():
        once = named.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
        named = named.join(repeated, "doc_id", "left_anti").unionByName(once)
    named = named.select("row.*")
    lone = groups.where("component_id is null").select("fingerprint").distinct()
    if lone.isEmpty():
        return named
    # A nameless text is told by its hash; of those with one fingerprint the smallest stays.
    nameless = rows.where("doc_id is null").withColumn("hash", F.xxhash64("text"))
    texts = nameless.select(F.col("hash").alias("doc_id"), "text").distinct()
    judged = fingerprints(texts).select(F.col("doc_id").alias("hash"), digits("print").alias("fingerprint"))
    first = judged.join(lone, "fingerprint", "left_semi").groupBy("fingerprint").agg(F.min("hash").alias("hash"))
    rest = nameless.join(first.select("hash"), "hash", "left_semi").dropDuplicates(["hash"])
    return named.unionByName(rest.select("row.*"))
