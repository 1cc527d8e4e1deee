"""Layers as catalog tables by month that are refreshed by what changed in their source.

A manifest holds, for every source file, its size, time of change and the months of its rows. A refresh lists the files, finds
new, changed and vanished ones, and rebuilds only the months that those have or had: their partitions are replaced by dynamic
overwrite, all other files stay as they are. The new manifest is written last, under a number of its own, and counts only
once Spark has marked it complete. A run that fails before that leaves the old one, and the next run does the same months anew.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_FILES = "path string, length bigint, changed_at timestamp, role string, months array<string>"
#: Up to so many changed files are read by name; beyond that the source's day column is read as a whole.
LISTED = 1000
NO_MONTH = "none"


def month_of(day: Column | str) -> Column:
    """``yyyy-MM``; rows without a day share a month of their own."""
    return F.coalesce(F.date_format(day, "yyyy-MM"), F.lit(NO_MONTH))


@dataclass(frozen=True)
class MonthlyLayer:
    """A table built month by month from the Parquet files under ``source``.

    ``build`` makes the layer's rows from source rows and must treat months apart: rows of a month depend on source rows of
    that month only (and on ``inputs``). It keeps or makes the column ``month``. A change under one of the ``inputs``, other
    folders that ``build`` reads, rebuilds every month. A file that changes without a new size or time is not noticed.
    """

    spark: SparkSession
    table: str
    root: str
    source: str
    day: str
    build: Callable[[DataFrame], DataFrame]
    inputs: list[str] = field(default_factory=list)

    # --- reading ---

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def file_times(self) -> DataFrame:
        """``month``, ``written_at``: when the newest file of each month was written."""
        rows = self.spark.read.parquet(f"{self.root}/data").select("month", "_metadata.file_modification_time")
        return rows.groupBy("month").agg(F.max("file_modification_time").alias("written_at"))

    # --- files ---

    def _fs(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _manifest(self) -> tuple[int, DataFrame]:
        """Number and rows of the last complete manifest; 0 and no rows before the first."""
        fs, jvm = self._fs(), self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.root}/manifest")
        numbers = [int(s.getPath().getName()) for s in fs.listStatus(folder)] if fs.exists(folder) else []
        done = [n for n in numbers if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self.root}/manifest/{n:09d}/_SUCCESS"))]
        if not done:
            return max(numbers, default=0), self.spark.createDataFrame([], _FILES)
        rows = self.spark.read.schema(_FILES).parquet(f"{self.root}/manifest/{max(done):09d}")
        return max(numbers), rows

    def _listed(self, folder: str, role: str) -> DataFrame:
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(folder)
        return files.select("path", "length", F.col("modificationTime").alias("changed_at"), F.lit(role).alias("role"))

    def _months_of(self, changed: DataFrame) -> DataFrame:
        """``path``, ``months`` of the changed source files."""
        names = [r.path for r in changed.select("path").limit(LISTED + 1).collect()]
        if not names:
            return self.spark.createDataFrame([], "path string, months array<string>")
        source = self.spark.read.parquet(self.source)
        if len(names) <= LISTED:
            rows = self.spark.read.schema(source.schema).option("basePath", self.source).parquet(*names)
            found = rows.select(F.col("_metadata.file_path").alias("path"), month_of(self.day).alias("month")).distinct()
        else:
            found = source.select(F.col("_metadata.file_path").alias("path"), month_of(self.day).alias("month")).distinct()
        per_file = found.groupBy(_same_path("path").alias("key")).agg(F.collect_set("month").alias("months"))
        return changed.select("path").join(per_file, _same_path("path") == F.col("key")).select("path", "months")

    # --- writing ---

    def _ensure_table(self, empty: DataFrame) -> None:
        namespace = self.table.rpartition(".")[0]
        if namespace:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace}")
        if not self.spark.catalog.tableExists(self.table):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in empty.schema if f.name != "month")
            self.spark.sql(f"CREATE TABLE {self.table} ({columns}, month string) USING parquet PARTITIONED BY (month) LOCATION '{self.root}/data'")

    def refresh(self) -> list[str]:
        """Bring the table up to date; the months that were rebuilt."""
        number, old = self._manifest()
        listed = self._listed(self.source, "source")
        for folder in self.inputs:
            listed = listed.unionByName(self._listed(folder, "input"))
        before = old.select(*[F.col(c).alias(f"old_{c}") for c in ("path", "length", "changed_at", "months")])
        both = listed.join(before, F.col("path") == F.col("old_path"), "full")
        same = F.coalesce((F.col("length") == F.col("old_length")) & (F.col("changed_at") == F.col("old_changed_at")), F.lit(False))
        moved = both.where(~same)
        changed = moved.where("path is not null and role = 'source'").select("path", "length", "changed_at", "role")
        fresh = changed.join(self._months_of(changed), "path", "left")
        inputs = listed.where("role = 'input'").withColumn("months", F.array().cast("array<string>"))
        kept = both.where(same & (F.col("role") == "source")).select("path", "length", "changed_at", "role", F.col("old_months").alias("months"))
        files = kept.unionByName(fresh.withColumn("months", F.coalesce("months", F.array().cast("array<string>")))).unionByName(inputs)
        # Written under the next number but complete only at the end: what follows reads it from there.
        draft = f"{self.root}/draft/{number + 1:09d}"
        files.write.mode("overwrite").parquet(draft)
        files = self.spark.read.schema(_FILES).parquet(draft)

        def months(df: DataFrame, column: str) -> set[str]:
            return {r.month for r in df.select(F.explode(column).alias("month")).distinct().collect()}  # months are few

        present, had = months(files, "months"), months(old, "months")
        if moved.where("coalesce(role, 'source') = 'input' or (path is null and size(old_months) = 0)").limit(1).count():
            touched = present | had
        else:
            touched = months(moved.where("old_months is not null"), "old_months")
            touched |= months(files.join(changed.select("path"), "path", "left_semi"), "months")
        source = self.spark.read.parquet(self.source)
        built = self.build(source.where(month_of(self.day).isin(*sorted(touched))) if touched else source.limit(0))
        columns = [c for c in built.columns if c != "month"]
        self._ensure_table(built)
        if touched & present:
            # A month's rows come out of its own task, so a partition gets few files.
            rows = built.select(*columns, "month").repartition("month")
            dynamic = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            dynamic.partitionBy("month").parquet(f"{self.root}/data")
        for month in sorted(touched - present):
            nothing = ", ".join(f"cast(null as {built.schema[c].dataType.simpleString()})" for c in columns)
            self.spark.sql(f"INSERT OVERWRITE TABLE {self.table} PARTITION (month = '{month}') SELECT {nothing} WHERE false")
        self.spark.sql(f"MSCK REPAIR TABLE {self.table} SYNC PARTITIONS")
        self.spark.catalog.refreshTable(self.table)
        files.write.parquet(f"{self.root}/manifest/{number + 1:09d}")
        return sorted(touched)


def _same_path(column: str) -> Column:
    """A path without what file systems write differently (``file:/x``, ``file:///x``)."""
    return F.regexp_replace(F.col(column), "^([a-z0-9]+):/+", "$1:/")
