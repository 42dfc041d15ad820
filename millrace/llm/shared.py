"""What several operators of this subpackage need: stored intermediates and components."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import delete_dir, scratch_dir

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextmanager
def noted() -> Iterator[list[str]]:
    """The folders that ``stored`` makes meanwhile, in order."""
    outer, made = _made.get(), []
    _made.set(made)
    try:
        yield made
    finally:
        _made.set(outer)
        if outer is not None:
            outer += made


def stored(df: DataFrame, purpose: str, codec: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, safe from lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path, compression=codec)
    if _made.get() is not None:
        _made.get().append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Meanwhile Spark removes a query's shuffle files when the query ends, not when the driver next collects garbage."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def discard(spark: SparkSession, folders: list[str]) -> None:
    """Delete folders that ``stored`` has made and no frame needs any more."""
    for folder in folders:
        delete_dir(spark, folder)


def whole_text(column: str = "text"):
    """The text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


#: Texts go to Python in batches of about this many bytes, whatever their number.
BATCH_BYTES = 8 << 20


def in_batches(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow``, with the session's batches cut to BATCH_BYTES if they are larger."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    conf = df.sparkSession.conf
    number, unit = re.fullmatch(r"(-?\d+)([kmgt]?)b?", conf.get(setting).strip().lower()).groups()
    size = int(number) << 10 * " kmgt".index(unit or " ")
    if not 0 < size <= BATCH_BYTES:
        conf.set(setting, str(BATCH_BYTES))
    return df.mapInArrow(function, schema)


def whole_row(df: DataFrame):
    """All columns as one struct, so that no name of theirs clashes with a working column."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns))


def components(edges: DataFrame, purpose: str) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is the smallest node.

    Each round every node moves to its smallest neighbour's smallest neighbour, and the graph
    is contracted to those; it ends when no edge is left. Sides of joins are read from stored
    tables, so that adaptive execution can split a hub's rows; minima are taken before the
    shuffle. Equal, repeated and reversed edges and loops are allowed; no edge gives no row.
    What a round has made goes when the next edges are written, but for its step.
    """
    spark = edges.sparkSession
    with noted() as made:
        edges = stored(
            edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
            f"{purpose}-edges",
        )
    steps = []
    while not edges.isEmpty():
        before = made[-1]
        with noted() as made:
            step, edges = contracted(edges, purpose)
        steps.append(step)
        discard(spark, [before, *(path for path in made[:-1] if f"/{purpose}-step-" not in path)])
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))

    def follow(at: DataFrame, step: DataFrame) -> DataFrame:
        hop = step.select(F.col("a").alias("component"), F.col("to").alias("next"))
        moved = at.join(hop, "component", "left")
        return stored(
            moved.select("node", F.coalesce("next", "component").alias("component")),
            f"{purpose}-member",
        )

    first = steps[0].select(F.col("a").alias("node"), F.col("to").alias("component"))
    return reduce(follow, steps[1:], first)


def contracted(edges: DataFrame, purpose: str) -> tuple[DataFrame, DataFrame]:
    """(where each node moves to, the edges that are left between those), both stored."""
    both = edges.select("a", "b").union(edges.select("b", "a"))
    near = stored(
        both.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("to")),
        f"{purpose}-near",
    )
    onward = near.select(F.col("a").alias("to"), F.col("to").alias("further"))
    step = stored(near.join(onward, "to").select("a", F.col("further").alias("to")), f"{purpose}-step")
    left = step.select("a", F.col("to").alias("to_a"))
    right = step.select(F.col("a").alias("b"), F.col("to").alias("to_b"))
    half = stored(edges.join(left, "a").select("to_a", "b"), f"{purpose}-half")
    joined = half.join(right, "b").where("to_a <> to_b")
    rest = joined.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct()
    return step, stored(rest, f"{purpose}-edges")


def let(value, body):
    """``body`` of ``value``, which is evaluated once however often ``body`` and its lambdas use it."""
    return F.transform(F.array(value), body)[0]


def keyed(docs: DataFrame, purpose: str) -> DataFrame:
    """(key, doc_id, text) for every row; ``key`` is one row's own, so that joins find back to it.

    It is doc_id where ids are there and differ; else rows are numbered in a stored copy.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("ids")).first()
    if counts["n"] == counts["ids"]:
        return rows.select(F.col("doc_id").alias("key"), "doc_id", "text")
    return stored(rows.select(F.monotonically_increasing_id().alias("key"), "doc_id", "text"), purpose)
