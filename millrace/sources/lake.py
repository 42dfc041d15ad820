"""Tables as versioned Parquet folders.

A write goes to a new folder ``v<n>`` and counts once its ``_COMMITTED`` file exists, so
a job that dies leaves nothing readable behind. Folders are never changed afterwards: a
DataFrame that ``read`` returned keeps its meaning while later versions are written.

Rows may carry a ``_slice`` (a batch, a micro-batch, a hash of the key). Then a write may
cover some slices only, and readers take each slice from the newest version that holds
it. One writer per table is assumed.

Bronze and the quarantine are cut by batch as well: a slice's rows lie in partition folders of
their ``_batch_id``, which Spark discovers, so that a filter or a join on it prunes files.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE = "_slice"
MARKER = "_COMMITTED"
WHOLE = ".whole"
#: Tables are written once and read a few times; Spark's default takes a quarter more.
CODEC = "zstd"
BATCH = "_batch_id"
BY_BATCH = ("bronze", "silver_quarantine")
#: Up to so many slices a task writes into each, and its files are still of a good size.
FEW_SLICES = 16
_VERSION = re.compile(r"/(?:v|_version=)(\d{8})(?:\.whole)?(?:/|$)")


def sliced(df: DataFrame, by: Column) -> DataFrame:
    return df.withColumn(SLICE, by)


def gathered(df: DataFrame, by: Column, *also: str) -> DataFrame:
    """Sliced, with each slice's rows brought together into files of a good size.

    Without it, every task writes a file into every slice. The hint lets adaptive
    execution split a slice that is too large for one task and merge small ones.
    """
    return sliced(df, by).hint("rebalance", SLICE, *also)


def cut_into(df: DataFrame, by: Column, slices: int) -> DataFrame:
    """Sliced, where the number of slices is known: rows move only if they are more than a few."""
    return sliced(df, by) if slices <= FEW_SLICES else gathered(df, by)


def bytes_under(spark: SparkSession, *paths: str) -> int:
    """Size of all files below the paths; their contents are not read."""
    if not paths:
        return 0
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    return listing.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


@dataclass(frozen=True)
class Lake:
    """A root folder with tables addressed by layer and name."""

    spark: SparkSession
    root: str

    def table(self, layer: str, name: str) -> "Table":
        return Table(self.spark, f"{self.root}/{layer}/{name}", layer in BY_BATCH)

    def tables(self, layer: str, family: str, names: Iterable[str]) -> DataFrame | None:
        """Rows of ``family/<name>`` for every name that exists.

        What several datasets report to is one table per dataset, each with one writer.
        """
        frames = [self.table(layer, f"{family}/{n}").read_or_none() for n in names]
        union = None
        for frame in frames:
            if frame is not None:
                union = frame if union is None else union.unionByName(frame, True)
        return union


class Table:
    def __init__(self, spark: SparkSession, path: str, by_batch: bool = False):
        self.spark = spark
        self.path = path
        self.by_batch = by_batch
        #: Folders of slices are only partition folders to Spark if their versions are, too.
        self.prefix = "_version=" if by_batch else "v"

    def exists(self) -> bool:
        return bool(self._versions())

    def schema(self) -> T.StructType:
        """As of the newest version; wider than older files if columns were added."""
        marker = self._path(f"{self._newest()}/{MARKER}")
        stream = self._fs().open(marker)
        text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        return T.StructType.fromJson(json.loads(text))

    def slices(self) -> list[str]:
        return sorted(self._located())

    def written(self) -> dict[str, int]:
        """The version that holds each current slice; later writes have higher numbers."""
        return {s: int(_VERSION.search(p)[1]) for s, p in self._located().items()}

    def read(self, slices: Iterable[str] | None = None) -> DataFrame:
        """The current rows, or those of the named slices."""
        located = self._located()
        chosen = located if slices is None else [s for s in slices if s in located]
        if not chosen:
            return self.spark.createDataFrame([], self.schema())
        reader, folders = self.spark.read.schema(self.schema()), sorted(located[s] for s in chosen)
        if self.by_batch:
            found = reader.option("basePath", self.path).parquet(*folders)
            return found.select(*self.schema().fieldNames())
        return reader.option("recursiveFileLookup", "true").parquet(*folders)

    def bytes(self, slices: Iterable[str] | None = None) -> int:
        """Stored size of the current rows, or of those of the named slices, from the listing alone."""
        located = self._located()
        return bytes_under(self.spark, *(located[s] for s in (located if slices is None else slices) if s in located))

    def read_or_none(self) -> DataFrame | None:
        return self.read() if self.exists() else None

    def overwrite(self, df: DataFrame) -> None:
        """Replace the table, its schema included."""
        target = self._new_folder(WHOLE)
        if self.by_batch and SLICE not in df.columns:
            df = gathered(df, F.lit("all"), *(c for c in (BATCH,) if c in df.columns))
        self._write_rows(df, target)
        self._commit(target, df.drop(SLICE).schema)

    def replace_slices(self, df: DataFrame, cover: Sequence[str]) -> None:
        """Replace the slices named in ``cover`` by the rows of ``df``, which has no others.

        New columns widen the table; older slices read NULL there. A covered slice for
        which ``df`` has no row becomes empty.
        """
        schema = df.drop(SLICE).schema
        stored = {}
        if self.exists():
            known = self.schema()
            for f in schema.fields:
                if f.name in known.fieldNames() and known[f.name].dataType != f.dataType:
                    raise ValueError(f"{self.path}: type of column {f.name!r} changed")
            fresh = [f for f in schema.fields if f.name not in known.fieldNames()]
            schema = T.StructType(known.fields + fresh)
            stored = self._located()
        target = self._new_folder("")
        self._write_rows(df, target)
        emptied = set(cover) - set(self._slice_folders(f"{target}/{SLICE}=*"))
        for name in sorted(emptied & set(stored)):
            # An empty folder hides the older one; it takes no job to make.
            self._fs().mkdirs(self._path(f"{target}/{stored[name].rsplit('/', 1)[1]}"))
        self._commit(target, schema)

    def append(self, df: DataFrame) -> None:
        """Add rows as a slice of their own."""
        name = f"append-{self._last_number() + 1:08d}"
        by_batch = self.by_batch and BATCH in df.columns
        self.replace_slices(gathered(df, F.lit(name), BATCH) if by_batch else sliced(df, F.lit(name)), [name])

    def retire(self, keep: int = 1) -> None:
        """Delete versions that hold no current slice, but for the newest ``keep`` ones.

        Frames that were read from a deleted version can no longer be used.
        """
        current = {_VERSION.search(p)[1] for p in self._located().values()}
        every = sorted({_VERSION.search(p)[1] for p in self._glob(f"{self.path}/{self.prefix}*")})
        for number in set(every[: max(0, len(every) - keep)]) - current:
            for folder in self._glob(f"{self.path}/{self.prefix}{number}*"):
                self._fs().delete(self._path(folder), True)

    # -- folders -------------------------------------------------------------------

    def _write_rows(self, df: DataFrame, target: str) -> None:
        cut = (SLICE, BATCH) if self.by_batch else (SLICE,)
        df.write.partitionBy(*(c for c in cut if c in df.columns)).parquet(target, compression=CODEC)

    def _commit(self, target: str, schema: T.StructType) -> None:
        fields = [{**f.jsonValue(), "nullable": True} for f in schema.fields]
        draft, marker = self._path(f"{target}/{MARKER}.draft"), self._path(f"{target}/{MARKER}")
        out = self._fs().create(draft, True)
        out.write(bytearray(json.dumps({"type": "struct", "fields": fields}), "utf-8"))
        out.close()
        if not self._fs().rename(draft, marker):  # readers see all of it or nothing
            raise FileExistsError(f"{target} was committed by another writer")

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _glob(self, pattern: str) -> list[str]:
        found = self._fs().globStatus(self._path(pattern))
        return sorted(s.getPath().toString() for s in found or [])

    def _last_number(self) -> int:
        """Unfinished versions count too: their folders are not used again."""
        return max((int(_VERSION.search(p)[1]) for p in self._glob(f"{self.path}/{self.prefix}*")), default=0)

    def _new_folder(self, suffix: str) -> str:
        return f"{self.path}/{self.prefix}{self._last_number() + 1:08d}{suffix}"

    def _versions(self) -> list[str]:
        """Committed version folders, newest first, back to the last whole one."""
        versions = []
        for marker in reversed(self._glob(f"{self.path}/{self.prefix}*/{MARKER}")):
            versions.append(marker[: -len(MARKER) - 1])
            if versions[-1].endswith(WHOLE):
                break
        return versions

    def _newest(self) -> str:
        versions = self._versions()
        if not versions:
            raise FileNotFoundError(f"no committed version of table {self.path}")
        return versions[0]

    def _slice_folders(self, pattern: str) -> dict[str, str]:
        return {unquote(p.rsplit("=", 1)[1]): p for p in self._glob(pattern)}

    def _located(self) -> dict[str, str]:
        """Slice name to folder; a version without slices is one slice named ''."""
        by_version: dict[str, list[str]] = {}
        for folder in self._glob(f"{self.path}/{self.prefix}*/{SLICE}=*"):
            by_version.setdefault(folder.rsplit("/", 1)[0], []).append(folder)
        located: dict[str, str] = {}
        for version in self._versions():
            for folder in by_version.get(version, []):
                located.setdefault(unquote(folder.rsplit("=", 1)[1]), folder)
            if version.endswith(WHOLE) and version not in by_version:
                located.setdefault("", version)
        return located
