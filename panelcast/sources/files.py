"""File sources and sinks: headed CSV with null sentinels, JSON lines, JSON report
documents, the panel table and model packages.  Schemas are always explicit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelcast.functions.text import coerce_numeric, null_sentinels, parse_day_first, strip


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark can list the path (no private handles, so it works on any session)."""
    try:
        spark.read.text(path)
        return True
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e.getCondition()):
            raise
        return False


def read_headed_csv(spark: SparkSession, path: str, key_name: str | None = None,
                    sentinel_cols: Sequence[str] = ()) -> DataFrame:
    """CSV with a header, every column read as text (no inference).  A blank first
    header arrives as ``_c0`` and is renamed to ``key_name``; textual null markers in
    ``sentinel_cols`` become null."""
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    if key_name and "_c0" in df.columns:
        df = df.withColumnRenamed("_c0", key_name)
    for c in sentinel_cols:
        df = df.withColumn(c, null_sentinels(c))
    return df


INTEGER_RE = r"^[+-]?\d+$"
CORRUPT = "_corrupt_line"


def _typed(name: str, kind: str) -> Column:
    c = null_sentinels(F.col(name))
    if kind == "string":
        return c
    if kind == "date":
        return parse_day_first(c)
    if kind in ("long", "int"):
        return F.when(strip(c).rlike(INTEGER_RE), strip(c).try_cast(kind))
    return coerce_numeric(c).cast(kind)


def read_typed_csv(spark: SparkSession, path: str, fields: dict[str, str], header: bool = True,
                   sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """CSV with a declared schema -> (good rows, rejected lines); together they are all lines.

    ``fields``: column name -> string, double, long, int or date (day first), by position.  A
    line with another number of fields than declared is malformed; a value that is neither a
    null marker nor readable as its column's type rejects its line.  Rejects: line (as read, or its fields),
    reason (``malformed`` or the first unreadable column), value (null if malformed)."""
    schema = ", ".join(f"`{c}` string" for c in [*fields, CORRUPT])
    text = (spark.read.schema(schema).option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
            # without pruning, so that a line is judged by all its fields whatever is selected later
            .option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False).csv(path))
    typed = {c: _typed(c, k) for c, k in fields.items()}
    unread = [F.when(null_sentinels(F.col(c)).isNotNull() & typed[c].isNull(), F.struct(F.lit(c).alias("reason"), F.col(c).alias("value")))
              for c, k in fields.items() if k != "string"]
    malformed = F.when(F.col(CORRUPT).isNotNull(), F.struct(F.lit("malformed").alias("reason"), F.lit(None).cast("string").alias("value")))
    judged = text.withColumn("_why", F.coalesce(malformed, *unread))
    line = F.coalesce(F.col(CORRUPT), F.concat_ws(sep, *[F.coalesce(F.col(c), F.lit("")) for c in fields]))
    good = judged.filter(F.col("_why").isNull()).select(*[v.alias(c) for c, v in typed.items()])
    return good, judged.filter(F.col("_why").isNotNull()).select(line.alias("line"), "_why.reason", "_why.value")


def write_headed_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_json_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines with malformed lines dropped; an absent path gives an empty frame."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_report(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A JSON document (possibly spanning lines, possibly holding bare NaN);
    absent -> empty frame with the schema."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema).option("multiLine", True)
            .option("allowNonNumericNumbers", True).json(path))


def write_report(report: DataFrame, path: str) -> None:
    """One-row nested report as JSON (a single small file)."""
    report.coalesce(1).write.mode("overwrite").json(path)


def write_panel(panel: DataFrame, path: str, partition_by: Sequence[str] = ("year",)) -> None:
    """Panel sink: parquet partitioned by year, so period filters prune files."""
    panel.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def read_panel(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def with_file_order(df: DataFrame, out: str = "file_seq") -> DataFrame:
    """Adds the place of each row in its files: (file, block, row), ordered as one reader going
    through the files by name sees them.

    A block is read by one task in order, so ids that grow inside a task order its rows, however
    blocks are dealt to tasks and executors; call it on the scan, before any shuffle."""
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("row"))
    return df.select("*", place.alias(out))


def last_by_file_order(df: DataFrame, keys: Sequence[str], seq: str = "file_seq") -> DataFrame:
    """The last row of each key in file order (a row that comes later overwrites earlier ones)."""
    rest = [c for c in df.columns if c not in keys and c != seq]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), seq).alias("_row"))
    return last.select(*keys, "_row.*")


def ensure_columns(df: DataFrame, defaults: dict) -> DataFrame:
    """Add a column with its default only when it is absent (existing nulls stay)."""
    out = df
    for c, v in defaults.items():
        if c not in out.columns:
            out = out.withColumn(c, F.lit(v[0]).cast(v[1]) if isinstance(v, tuple) else F.lit(v))
    return out
