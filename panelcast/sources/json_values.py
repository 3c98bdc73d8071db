"""JSON lines of any shape, read as VARIANT: no schema is declared and nothing is dropped from objects.

Keys are listed at any depth by opening one level after another (as many passes as the deepest
document has levels), each an explode of the values that are objects or arrays; counts are
aggregated with map-side partial sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.sources.files import path_exists

#: Names of the types that ``schema_of_variant`` tells apart, by the word its text starts with.
KINDS = {"OBJECT": "object", "ARRAY": "array", "STRING": "string", "BOOLEAN": "boolean", "VOID": "null"}


def read_json_values(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(documents as ``doc``, lines that are no JSON as ``line``); an absent path gives empty frames."""
    lines = spark.read.text(path) if path_exists(spark, path) else spark.createDataFrame([], "value string")
    lines = lines.where(F.length(F.trim("value")) > 0).withColumn("doc", F.try_parse_json("value"))
    return lines.where(F.col("doc").isNotNull()).select("doc"), lines.where(F.col("doc").isNull()).select(F.col("value").alias("line"))


def kind_of(value) -> F.Column:
    """object, array, string, boolean, null or number."""
    word = F.regexp_extract(F.schema_of_variant(value), r"^[A-Z]+", 0)
    names = F.create_map(*[F.lit(x) for kv in KINDS.items() for x in kv])
    return F.coalesce(F.try_element_at(names, word), F.lit("number"))


def list_paths(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """path, kind, n: every key at any depth (``[]`` for array items) with the kinds of its values."""
    spark = docs.sparkSession
    level = docs.select(F.lit("$").alias("path"), F.col(doc).alias("v"))
    found = []
    while True:
        counts = level.groupBy("path", kind_of(F.col("v")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))
        # a handful of (path, kind) pairs tells whether there is a level below
        rows = counts.collect()
        found += [(r["path"], r["kind"], r["n"]) for r in rows]
        if not any(r["kind"] in ("object", "array") for r in rows):
            return spark.createDataFrame(found, "path string, kind string, n long")
        opened = level.where(kind_of(F.col("v")).isin("object", "array")).withColumn("array", kind_of(F.col("v")) == "array")
        inner = opened.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
        level = inner.select(F.concat("path", F.when(F.col("array"), F.lit("[]")).otherwise(F.concat(F.lit("."), F.col("key")))).alias("path"),
                             F.col("value").alias("v"))


def field(path: str, kind: str, doc: str = "doc") -> F.Column:
    """A value by its path, null if it is absent or of another kind."""
    return F.try_variant_get(F.col(doc), path, kind)

