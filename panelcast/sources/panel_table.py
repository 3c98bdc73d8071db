"""The panel as a laid-out table: bucketed and sorted by entity, one partition a year.

Windows, profiles and forecasts work by entity, so on this table they plan without an exchange:
the panel is shuffled once, when it is written.  Changed years are overwritten alone
(``refresh_years``).  ``stored_panel`` keeps one table for each state of the input files in the
shared folder: queries over unchanged inputs read it, a changed file makes a new one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.session import scratch_path
from panelcast.sources.files import path_exists

ENTITY, ORDER = "entity", ("year", "month")


def save_panel(panel: DataFrame, name: str, path: str, buckets: int | None = None, entity: str = ENTITY,
               order: Sequence[str] = ORDER, partition: str = "year") -> DataFrame:
    """Writes the table and registers it under ``name``; buckets: the session's shuffle partitions."""
    spark = panel.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    (panel.repartition(buckets, entity).sortWithinPartitions(partition, entity, *order).write.mode("overwrite").format("parquet")
     .partitionBy(partition).bucketBy(buckets, entity).sortBy(entity, *[c for c in order if c != partition]).option("path", path).saveAsTable(name))
    return spark.table(name).select(*panel.columns)


def refresh_years(rows: DataFrame, name: str) -> None:
    """Replaces the years that occur in ``rows``; all others stay as they are."""
    spark = rows.sparkSession
    target = spark.table(name)
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode", None)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        rows.select(*target.columns).write.mode("overwrite").insertInto(name)
    finally:
        if before is None:
            spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
        else:
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def files_state(spark: SparkSession, paths: Sequence[str]) -> str:
    """Number of the files under the paths and a sum of hashes of their names, times and lengths."""
    files = spark.read.format("binaryFile").load(list(paths)).select("path", "modificationTime", "length")
    row = files.agg(F.count(F.lit(1)), F.sum(F.xxhash64("path", "modificationTime", "length").cast("decimal(38,0)"))).first()
    return f"{row[0]}/{row[1]}"


def stored_panel(spark: SparkSession, paths: Sequence[str], settings: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The panel that ``build`` makes from the files at ``paths`` with ``settings``, written once a session."""
    key = f"{spark.sparkContext.applicationId}|{settings}|{files_state(spark, paths)}"
    name = f"panel_{hashlib.sha256(key.encode()).hexdigest()[:20]}"
    if spark.catalog.tableExists(name):
        where = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first()["data_type"]
        if path_exists(spark, where):
            return spark.table(name)
    panel = build()
    return save_panel(panel, name, scratch_path(spark, "panel-table"))
