"""CSV drops, in batch and as a stream of files.

Columns are matched by the names in each file's first line, which may order them in any way,
leave some out or add unknown ones; the latter are rescued. A row ends at the line break:
quoted line breaks are not supported, as files are split for reading.
"""

from __future__ import annotations

import datetime as dt
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.datasets import Dataset
from millrace.operators.columns import stamp_ingestion
from millrace.operators.rescue import UNKNOWN, type_and_rescue
from millrace.session import scratch_dir

CORRUPT = "_corrupt_record"
FILE = "_source_file"
BLOCK = "_block"
#: Files of a read whose layouts are broadcast, some hundred bytes each; beyond, lines are joined by shuffles.
MOST_FILES = 100_000
#: Follows the last field of a header; no header has it.
MARK = "\x01"
CSV_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
BYTE_ORDER_MARK = "\ufeff"
#: Lines without one are cut at commas alone, which takes half the time of a CSV parser.
QUOTE = '"'


def with_corrupt_record(schema: T.StructType) -> T.StructType:
    if CORRUPT in schema.fieldNames():
        return schema
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def located(lines: DataFrame) -> DataFrame:
    return lines.select(
        "value", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK)
    )


def stream_lines(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Lines of new files, each with its file; a file comes in one micro-batch."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return located(reader.text(path))


def read_drops(spark: SparkSession, path: str, dataset: Dataset) -> DataFrame:
    return by_name(located(spark.read.text(path)), dataset)


def headers(lines: DataFrame) -> DataFrame:
    """(file, header): the first line of each file that is not blank.

    A file's beginning is read by one task, which numbers its lines in order.
    """
    first = lines.where((F.col(BLOCK) == 0) & (F.trim("value") != ""))
    first = first.select(FILE, "value", F.monotonically_increasing_id().alias("at"))
    return first.groupBy(FILE).agg(F.min_by("value", "at").alias("header"))


def names_keys(dataset: Dataset) -> Column:
    """A header that may have the names of all key columns as fields."""
    fields = (rf'(?i)(^{BYTE_ORDER_MARK}?|,)\s*"?\s*{re.escape(k)}\s*"?\s*(,|$)' for k in dataset.key)
    return reduce(Column.__and__, (F.col("header").rlike(f) for f in fields))


def cells(line: Column, width: int) -> Column:
    """The first ``width`` fields of a line."""
    row = F.from_csv(line, ", ".join(f"c{i} string" for i in range(width)))
    return F.array(*(row[f"c{i}"] for i in range(width)))


def unlike(names: Column, mark: str) -> Column:
    """Names with repeated ones numbered."""

    def named(name: Column, i: Column) -> Column:
        copies = F.size(F.filter(F.slice(names, 1, i), lambda n: n == name))
        return F.when(copies > 0, F.concat(name, F.lit(mark), (copies + 1).cast("string"))).otherwise(name)

    return F.transform(names, named)


def layouts(first: DataFrame, dataset: Dataset, width: int) -> DataFrame:
    """(file, header, n, places, others) of the files whose header may name the key; see ``names_all_keys``.

    ``places`` has the number of each declared column's field, 0 for none; names are compared
    without blanks around them and whatever their case. ``others`` are the unknown fields.
    """
    plain = F.regexp_replace("header", f"^{BYTE_ORDER_MARK}", "")
    found = first.where(names_keys(dataset)).withColumn("cells", cells(F.concat(plain, F.lit(f",{MARK}")), width + 1))
    found = found.withColumn("n", F.array_position("cells", MARK).cast("int") - 1)
    trimmed = F.transform(F.slice("cells", 1, F.greatest("n", F.lit(0))), lambda c: F.trim(F.coalesce(c, F.lit(""))))
    found = found.withColumn("names", unlike(trimmed, "#")).withColumn("names", unlike(F.col("names"), "##"))
    low = F.transform("names", F.lower)
    found = found.withColumn("places", F.array(*(F.array_position(low, c.lower()).cast("int") for c in dataset.columns)))
    every = F.transform("names", lambda name, i: F.struct(name.alias("key"), (i + 1).alias("at")))
    others = F.filter(every, lambda e: ~F.array_contains("places", e["at"]))
    return found.select(FILE, "header", "n", "places", others.alias("others"))


def names_all_keys(dataset: Dataset) -> Column:
    """Of a layout: its fields name all key columns."""
    places = (F.get("places", F.lit(list(dataset.columns).index(k))) > 0 for k in dataset.key)
    return reduce(Column.__and__, places, F.col("n") > 0)


def by_name(lines: DataFrame, dataset: Dataset) -> DataFrame:
    """Declared columns as text, the corrupt line, unknown columns, the file.

    The first line of a file is its header; lines that spell it again are none of its rows. All
    layouts are parsed in one pass: a line is filled up to the widest layout's number of fields
    and its file's layout, joined to it, says which field is which column. Headers and
    layouts are stored; only their number and the widest one's fields come to the driver. Lines with too few or too many fields are
    corrupt, as is every line of a file whose header does not name the key. Blank lines are
    skipped.
    """
    spark, folder = lines.sparkSession, scratch_dir(lines.sparkSession, "headers")
    headers(lines).write.parquet(f"{folder}/first")
    first = spark.read.schema(f"{FILE} string, header string").parquet(f"{folder}/first")
    fields = F.max(F.when(names_keys(dataset), F.regexp_count("header", F.lit(",")) + 1))
    counted = first.agg(F.count(F.lit(1)).alias("files"), fields.alias("width")).first()
    width = counted["width"] or 1
    # Stored before they are filtered: a filter would repeat all of their expressions below each other.
    layout = layouts(first, dataset, width)
    layout.write.parquet(f"{folder}/layouts")
    layout = spark.read.schema(layout.schema).parquet(f"{folder}/layouts").where(names_all_keys(dataset))
    if counted["files"] <= MOST_FILES:
        layout = F.broadcast(layout)

    rows = lines.where(F.trim("value") != "").join(layout, FILE, "left")
    rows = rows.where(F.col("header").isNull() | (F.col("value") != F.col("header")))
    ddl = ", ".join(f"c{i} string" for i in range(width)) + f", {CORRUPT} string"
    filled = F.concat("value", F.repeat(F.lit(","), F.lit(width) - F.col("n")))
    quoted = F.contains("value", F.lit(QUOTE))
    parsed = rows.select(
        "value", FILE, "n", "places", "others",
        F.when(~quoted, F.split("value", ",", -1)).alias("plain"),
        F.when(quoted, F.from_csv(filled, ddl, CSV_OPTIONS)).alias("row"),
    )
    whole = F.when(F.col("plain").isNull(), F.col(f"row.{CORRUPT}").isNull()).otherwise(F.size("plain") == F.col("n"))
    parsed = parsed.select(
        "value", FILE, "places", "others", (F.col("n").isNotNull() & whole).alias("sound"),
        F.coalesce("plain", F.array(*(F.col(f"row.c{i}") for i in range(width)))).alias("cells"),
    )

    def cell(at: Column) -> Column:
        return F.nullif(F.get("cells", at - 1), F.lit(""))

    # A key that is there twice, by another case, is numbered already; see ``unlike``.
    unknown = F.filter(
        F.transform("others", lambda o: F.struct(o["key"].alias("key"), cell(o["at"]).alias("value"))),
        lambda e: e["value"].isNotNull(),
    )
    none = F.create_map().cast("map<string,string>")
    return parsed.select(
        *(cell(F.get("places", F.lit(k))).alias(c) for k, c in enumerate(dataset.columns)),
        F.when(~F.col("sound"), F.col("value")).alias(CORRUPT),
        F.when(F.size("others") > 0, F.map_from_entries(unknown)).otherwise(none).alias(UNKNOWN),
        FILE,
    )


def as_bronze(
    raw: DataFrame,
    dataset: Dataset,
    environment: str,
    batch_id: str,
    at: dt.datetime | None = None,
) -> DataFrame:
    """Typed columns, what did not fit, and where each row came from."""
    typed = type_and_rescue(raw, dataset.schema, F.col(FILE))
    return stamp_ingestion(typed, environment, batch_id, F.col(FILE), at)
