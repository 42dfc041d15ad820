"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import WORD, stored, whole_row

#: Weights of the sources in code point order, repeating; null comes last.
WEIGHTS = (3, 1, 2)
#: All sources together are mixed to this share of their words.
TOTAL_PERCENT = 150
#: No source and no document is taken more often than this.
MOST_COPIES = 2
#: Buckets of rank per source and level; three levels leave one row in 16 million to sort.
BUCKETS = 256
LEVELS = 3
#: Documents with fewer words than this are the less likely to be repeated the shorter they are.
FULL_PREFERENCE_WORDS = 200


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sized: DataFrame, weights=WEIGHTS, total_percent: int = TOTAL_PERCENT, most: int = MOST_COPIES
) -> DataFrame:
    """(source, source_size, target) per source of ``sized`` (source, size).

    Weights are dealt out over the sources in code point order. A target stops at ``most``
    times the source's size; what it leaves over goes to the rest by weight. In order of
    (most * size / weight) the sources that stop come first, so one running sum finds them.
    Works on one row per source.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = sums.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    capped = ranked.withColumn("weight", weight.cast("long")).withColumn("most", F.col("source_size") * most)
    by_level = Window.orderBy(F.col("most") / F.col("weight"), "rank")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    filled = (
        capped.withColumn("all_words", F.sum("source_size").over(everything) * total_percent / 100)
        .withColumn("rest_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("stopped", F.coalesce(F.sum("most").over(before), F.lit(0)))
        .withColumn("stops", F.col("most") * F.col("rest_weight") + F.col("stopped") * F.col("weight") <= F.col("all_words") * F.col("weight"))
        .withColumn("left", F.col("all_words") - F.sum(F.when(F.col("stops"), F.col("most")).otherwise(0)).over(everything))
        .withColumn("sharing", F.sum(F.when(F.col("stops"), 0).otherwise(F.col("weight"))).over(everything))
    )
    target = F.when(F.col("stops"), F.col("most")).otherwise(F.col("left") * F.col("weight") / F.col("sharing"))
    return filled.select("source", "source_size", target.cast("double").alias("target"))


def uniform(seed: str) -> Column:
    """A number between 0 and 1, both excluded, from the document's id, size and the seed alone."""
    key = F.concat_ws("/", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("size").cast("string"))
    return (F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def preference(size: str = "size") -> Column:
    return 0.25 + 0.75 * F.least(F.lit(1.0), F.col(size) / FULL_PREFERENCE_WORDS)


def with_rank(rows: DataFrame, seed: str) -> DataFrame:
    """Adds ``sure`` (whole copies for certain), ``fraction`` and ``rank`` (0 to 1) to rows with
    doc_id, size, source_size and target. The rank falls with the odds of being included."""
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    u, p = F.col("u"), F.col("p")
    odds = (u / (1 - u)) / (p / (1 - p))
    known = rows.withColumns({"sure": F.floor(ratio).cast("long"), "u": uniform(seed)})
    chance = known.withColumn("fraction", ratio - F.col("sure")).withColumn(
        "p", 1 - F.pow(1 - F.col("fraction"), preference())
    )
    return chance.withColumn("rank", F.when(p > 0, odds / (1 + odds)).otherwise(F.lit(1.0))).drop("u", "p")


def by_source(rows: DataFrame, table: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of a table that has one row per source; null is a source."""
    of = table.withColumnRenamed("source", "of_source")
    return rows.join(of, F.col("source").eqNullSafe(F.col("of_source")), how).drop("of_source")


def in_bucket() -> Column:
    high = F.col("low") + F.col("width")
    return (F.col("rank") >= F.col("low")) & ((F.col("rank") < high) | (high == 1))


def place() -> Column:
    return F.struct("rank", "doc_id", "size")


def drawn() -> Column:
    """Whether a row's rank lies before the place where its source's words run out."""
    return (F.col("rank") < F.col("low")) | F.coalesce(in_bucket() & (place() <= F.col("limit")), F.lit(False))


def source_cuts(sized: DataFrame, seed: str, weights, total_percent: int, most: int) -> DataFrame:
    """One row per source of ``sized`` (doc_id, source, size): all that decides about a document.

    Ranks are cut into buckets, and only the bucket in which a source's words run out is looked
    at more closely, level by level, so that no source is ever sorted in one task.
    """
    targets = stored(source_targets(sized, weights, total_percent, most), "mix-targets")
    ranked = stored(with_rank(by_source(sized, targets), seed), "mix-ranked")
    needed = F.round(F.max("fraction") * F.max("source_size"))
    cut = ranked.groupBy("source").agg(needed.alias("needed")).select(
        "source", F.lit(0.0).alias("low"), F.lit(1.0).alias("width"), "needed"
    )
    cut = stored(cut, "mix-cut")
    for _ in range(LEVELS):
        step = F.least(F.lit(BUCKETS - 1), F.floor((F.col("rank") - F.col("low")) / F.col("width") * BUCKETS)).cast("int")
        counted = (
            by_source(ranked, cut)
            .where(in_bucket())
            .withColumn("step", step)
            .groupBy("source", "low", "width", "needed", "step")
            .agg(F.sum("size").cast("double").alias("words"))
        )
        running = F.sum("words").over(Window.partitionBy("source").orderBy("step"))
        at = counted.withColumn("before", running - F.col("words")).where("before <= needed")
        last = at.groupBy("source", "low", "width", "needed").agg(F.max(F.struct("step", "before")).alias("last"))
        cut = stored(
            last.select(
                "source",
                (F.col("low") + F.col("last.step") * F.col("width") / BUCKETS).alias("low"),
                (F.col("width") / BUCKETS).alias("width"),
                (F.col("needed") - F.col("last.before")).alias("needed"),
            ),
            "mix-cut",
        )
    close = (
        by_source(ranked, cut)
        .where(in_bucket())
        .groupBy("source", "rank", "doc_id", "size", "needed")
        .agg(F.sum("size").cast("double").alias("words"))
    )
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("rank", "doc_id", "size"))
    won = close.withColumn("upto", upto).where("upto <= needed").groupBy("source").agg(
        F.max(place()).alias("limit"), F.max("upto").alias("used")
    )
    lacking = F.col("needed") - F.coalesce("used", F.lit(0.0))
    limits = stored(by_source(cut, won, "left").withColumn("lacking", lacking).drop("needed", "used"), "mix-limits")
    # The last place goes to the document left that fits the words still lacking best.
    misfit = F.abs(F.col("size") - F.col("lacking"))
    left = by_source(ranked, limits).where(~drawn() & (F.col("fraction") > 0) & (misfit < F.col("lacking")))
    last = left.groupBy("source").agg(
        F.min(F.struct(misfit.alias("misfit"), "rank", "doc_id", "size")).alias("last")
    )
    everything = by_source(by_source(targets, limits), last, "left")
    return stored(everything.drop("lacking"), "mix-cuts")


def with_copies(rows: DataFrame, cuts: DataFrame, seed: str) -> DataFrame:
    """``rows`` (doc_id, source, size, ...) with source_size, target and ``copies``."""
    known = with_rank(by_source(rows, cuts), seed)
    is_last = F.col("last").isNotNull() & place().eqNullSafe(F.struct("last.rank", "last.doc_id", "last.size"))
    once_more = F.when((F.col("fraction") > 0) & (drawn() | is_last), 1).otherwise(0)
    return known.withColumn("copies", F.col("sure") + once_more)


def sizes(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", word_count().alias("size"))


def mix(docs: DataFrame, seed: str = "mix", weights=WEIGHTS, total_percent: int = TOTAL_PERCENT, most: int = MOST_COPIES) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for every row of ``docs``.

    A source to be taken r times gives every document floor(r) whole copies for certain. The
    fraction left is drawn by Pareto order sampling: a document's chance p to be included is
    1 - (1 - fraction) ** preference, u is its own random number, and documents are ranked by
    (u / (1 - u)) / (p / (1 - p)). The sample's size is fixed in words: ranks are taken for as
    long as they fit into the words needed, and the last place goes to the document left
    whose size comes closest to the words still lacking.

    Random numbers come from doc_id and size, hence reruns and other partitionings agree. Null
    text: size 0, taken 0. Null source: a source of its own, last in order. Documents of equal
    rank go by doc_id; rows that repeat id, source and size are taken or left alike.
    """
    sized = stored(sizes(docs), "mix-sizes")
    cuts = source_cuts(sized, seed, weights, total_percent, most)
    return with_copies(sized, cuts, seed).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed_documents(
    docs: DataFrame, seed: str = "mix", weights=WEIGHTS, total_percent: int = TOTAL_PERCENT, most: int = MOST_COPIES
) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as it has copies, all columns kept.

    Documents meet only the table of sources, so texts are not shuffled. A document without
    words has no copies.
    """
    cuts = source_cuts(stored(sizes(docs), "mix-sizes"), seed, weights, total_percent, most)
    rows = docs.select(
        whole_row(docs).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "source", word_count().alias("size")
    )
    taken = with_copies(rows, cuts, seed).where("copies > 0 and size > 0")
    times = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return taken.select("row", times.alias("nr")).select("row.*")
