"""Tables kept by source month: only the months that changed are written again.

A kept table has one folder per service and source month and a manifest of what each
folder was made from. An update compares the manifest with what is wanted now, takes
away folders that are no longer wanted, writes the changed ones and commits the new
manifest last. A run that ends half-way leaves the old manifest, so the next one finds
the same changes, or more, and does them again. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.session import remove_path
from kerbside.sources.tables import save_parquet

MONTH_KEYS = ("service_type", "src_year", "src_month")
ADDED, REPLACED, REMOVED = "added", "replaced", "removed"
_KEY_TYPES = "service_type string, src_year int, src_month int"
_FOLDER = r"service_type=([^/]+)/src_year=(\d+)/src_month=(\d+)/"

Month = tuple[str, int, int]


def _found(spark: SparkSession, path: str) -> DataFrame | None:
    """Paths of all files below a folder, None when there is no such folder."""
    try:
        return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def in_months(months: list[Month]):
    """Condition on the month keys; it reads the named folders only."""
    return F.concat_ws("|", *MONTH_KEYS).isin(["|".join(map(str, month)) for month in months])


def manifest_changes(kept: DataFrame, wanted: DataFrame) -> DataFrame:
    """Month keys and what happens to them: ``added``, ``replaced`` or ``removed``; unchanged months are left out."""
    before = kept.select(*MONTH_KEYS, F.col("made_from").alias("before"))
    after = wanted.select(*MONTH_KEYS, F.col("made_from").alias("after"))
    change = (
        F.when(F.col("before").isNull(), ADDED)
        .when(F.col("after").isNull(), REMOVED)
        .when(F.col("before") != F.col("after"), REPLACED)
    )
    return before.join(after, list(MONTH_KEYS), "full").select(*MONTH_KEYS, change.alias("change")).filter("change IS NOT NULL")


@dataclass(frozen=True)
class KeptTable:
    """``root`` holds the month folders; the manifest of update n lies beside it, in ``run=n``."""

    root: str

    @property
    def manifests(self) -> str:
        return f"{self.root}_manifest"

    def _last_run(self, spark: SparkSession) -> int:
        files = _found(spark, self.manifests)
        if files is None:
            return 0
        return files.agg(F.max(F.regexp_extract("path", r"/run=(\d+)/", 1).cast("int"))).first()[0] or 0

    def manifest(self, spark: SparkSession) -> DataFrame:
        """Month keys, ``made_from``, the facts given with it, and ``written_in``, the update that wrote the folder."""
        run = self._last_run(spark)
        if not run:
            return spark.createDataFrame([], f"{_KEY_TYPES}, made_from string, written_in int")
        return spark.read.parquet(f"{self.manifests}/run={run}")

    def read(self, spark: SparkSession, schema: str | None = None) -> DataFrame:
        """All months; ``schema`` (DDL) stands in where none has rows."""
        if _found(spark, self.root) is None:
            if schema is None:
                raise FileNotFoundError(self.root)
            return spark.createDataFrame([], schema)
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.parquet(self.root)

    def update(
        self, spark: SparkSession, wanted: DataFrame, build: Callable[[list[Month]], DataFrame], rebalance: bool = False
    ) -> list[tuple[str, int, int, str]]:
        """Bring the table to ``wanted`` (month keys, ``made_from``, facts to note) and return what changed.

        ``build`` gives the rows of the months it is asked for, with the month keys.
        ``made_from`` is text that differs when the month's source does. A folder that no
        manifest names, left by a run that ended half-way, goes too when nothing wants it.
        ``rebalance`` gathers a month's rows into few files; rows read from monthly files
        already come that way.
        """
        run, kept = self._last_run(spark), self.manifest(spark)
        changed = [tuple(row) for row in manifest_changes(kept, wanted).collect()]
        written = sorted(key for *key, change in changed if change != REMOVED)
        gone = {tuple(key) for *key, change in changed if change != ADDED}
        for service, year, month in gone | self._strays(spark, wanted):
            remove_path(spark, f"{self.root}/service_type={service}/src_year={year}/src_month={month}")
        if written:
            rows = build([tuple(key) for key in written])
            save_parquet(rows, self.root, MONTH_KEYS, rebalance=rebalance, partitionOverwriteMode="dynamic")
        if changed:
            old = kept.select(*MONTH_KEYS, F.col("written_in").alias("old"))
            now = F.when(in_months(written), run + 1).otherwise(F.col("old")) if written else F.col("old")
            noted = wanted.join(old, list(MONTH_KEYS), "left").withColumn("written_in", now.cast("int")).drop("old")
            save_parquet(noted.coalesce(1), f"{self.manifests}/run={run + 1}")
        return changed

    def _strays(self, spark: SparkSession, wanted: DataFrame) -> set[Month]:
        files = _found(spark, self.root)
        if files is None:
            return set()
        keys = [F.regexp_extract("path", _FOLDER, i + 1).alias(key) for i, key in enumerate(MONTH_KEYS)]
        folders = files.select(*keys).distinct().withColumns({k: F.col(k).cast("int") for k in MONTH_KEYS[1:]})
        return {tuple(row) for row in folders.join(wanted, list(MONTH_KEYS), "left_anti").collect()}
