"""File sink: written beside the target, counted, and swapped in."""

from __future__ import annotations

from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from qualitypipe import fixed_values as fixed

# Formats whose files know how many rows they hold, so that a count reads no rows.
COUNTED_FORMATS = {"parquet", "orc"}


@dataclass(frozen=True)
class FileSink:
    path: str = fixed.OUTPUT_PATH
    format: str = fixed.OUTPUT_FORMAT


class WriteError(RuntimeError):
    """What was written is not what was counted, or could not be put in place. The old rows are where they were."""


class _Folder:
    """A path and the Hadoop file system it lies on."""

    def __init__(self, spark: SparkSession, path: str):
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") or path)
        self.system = hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        self.path = self.system.makeQualified(hadoop)

    def sibling(self, purpose: str) -> _Folder:
        """A new name in the same parent, hidden from readers of the parent, on the same file system."""
        other = object.__new__(_Folder)
        other.system = self.system
        other.path = self.path.suffix("").getParent().suffix(f"/.{self.path.getName()}-{purpose}-{uuid4().hex}")
        return other

    def __str__(self) -> str:
        return self.path.toString()

    def exists(self) -> bool:
        return self.system.exists(self.path)

    def rename_to(self, other: _Folder) -> None:
        if not self.system.rename(self.path, other.path):
            raise WriteError(f"could not rename {self} to {other}")

    def delete(self) -> None:
        self.system.delete(self.path, True)


def write_files(
    df: DataFrame, path: str, format: str = fixed.OUTPUT_FORMAT, options: dict | None = None
) -> int:
    """Replace ``path`` by the rows of ``df`` in any Spark file format; returns how many were written.

    Rows are written to a hidden folder beside the target, and take its place by a rename when all are there, so a
    write that fails leaves the old rows. The count is observed at the top of the plan during the write itself. That place
    belongs to the job's result stage, whose tasks are counted once each even if an executor is lost and earlier
    stages run again. Parquet and ORC files must hold as many rows by their own footers.

    Between the two renames the path is missing for a moment. On stores without renames of their own, such as most object
    stores, each copies the files.
    """
    spark = df.sparkSession
    target = _Folder(spark, path)
    staged, replaced = target.sibling("staged"), target.sibling("replaced")
    written = Observation()
    counted = df.observe(written, F.count(F.lit(1)).alias("rows"))
    try:
        counted.write.format(format).options(**(options or {})).mode("errorifexists").save(str(staged))
        rows = written.get["rows"]
        if format.lower() in COUNTED_FORMATS:
            held = spark.read.format(format).schema(df.schema).load(str(staged)).count()
            if held != rows:
                raise WriteError(f"{rows} rows were written to {staged}, which holds {held}")
        _swap(staged, target, replaced)
    except BaseException:
        staged.delete()
        raise
    return rows


def _swap(staged: _Folder, target: _Folder, replaced: _Folder) -> None:
    """The staged folder in the place of the target; what was there comes back if that fails."""
    old = target.exists()
    if old:
        target.rename_to(replaced)
    try:
        staged.rename_to(target)
    except BaseException:
        if old:
            replaced.rename_to(target)
        raise
    if old:
        replaced.delete()


def preview(df: DataFrame, n: int = fixed.PREVIEW_ROWS) -> DataFrame:
    """The first ``n`` rows as a DataFrame; the caller shows them."""
    return df.limit(n)
