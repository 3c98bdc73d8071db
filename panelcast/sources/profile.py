"""Profile of any table in one pass: exact counts next to mergeable sketches.

A batch is reduced to one row a column: rows, nulls, extremes (exact), a HyperLogLog sketch of its
distinct values, a KLL sketch of its numbers and a top-k sketch of its values.  Batches' rows
can be stored and merged later, so a growing source is never read twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

#: Items a top-k sketch tracks; it is exact for columns with fewer distinct values.
TRACKED = 1000


def sketch(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row a column: column, kind, n_rows, n_nulls, least, most (texts), least_number, most_number, hll, kll, top."""
    cols = cols or df.columns
    numeric = {f.name: isinstance(f.dataType, NumericType) for f in df.schema.fields}
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    aggs = []
    for c in cols:
        text, number = F.col(f"`{c}`").cast("string"), F.col(f"`{c}`").cast("double") if numeric[c] else F.lit(None).cast("double")
        aggs.append(F.struct(
            F.lit(c).alias("column"), F.lit(kinds[c]).alias("kind"), F.count(F.lit(1)).alias("n_rows"), F.count_if(text.isNull()).alias("n_nulls"),
            F.min(text).alias("least"), F.max(text).alias("most"), F.min(number).alias("least_number"), F.max(number).alias("most_number"),
            F.hll_sketch_agg(text).alias("hll"), F.kll_sketch_agg_double(number).alias("kll"),
            F.expr(f"approx_top_k_accumulate(cast(`{c}` as string), {TRACKED})").alias("top")).alias(f"s_{len(aggs)}"))
    wide = df.agg(*aggs)
    return wide.select(F.explode(F.array(*[F.col(f"s_{i}") for i in range(len(cols))])).alias("s")).select("s.*")


def merge(batches: DataFrame) -> DataFrame:
    """Batches' rows -> one row a column, of the same form."""
    return batches.groupBy("column", "kind").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_nulls").alias("n_nulls"), F.min("least").alias("least"), F.max("most").alias("most"),
        F.min("least_number").alias("least_number"), F.max("most_number").alias("most_number"), F.hll_union_agg("hll").alias("hll"),
        F.kll_merge_agg_double("kll").alias("kll"), F.expr(f"approx_top_k_combine(top, {TRACKED})").alias("top"))


def read_profile(merged: DataFrame, top: int = 5) -> DataFrame:
    """column, kind, n_rows, n_nulls, n_distinct (estimate), least and most (numbers as numbers),
    median (estimate), frequent (values with counts, most frequent first)."""
    number = F.col("most_number").isNotNull()
    return merged.select(
        "column", "kind", "n_rows", "n_nulls", F.hll_sketch_estimate("hll").alias("n_distinct"),
        F.when(number, F.col("least_number").cast("string")).otherwise(F.col("least")).alias("least"),
        F.when(number, F.col("most_number").cast("string")).otherwise(F.col("most")).alias("most"),
        F.when(number, F.kll_sketch_get_quantile_double("kll", F.lit(0.5))).alias("median"),
        F.slice(F.filter(F.expr(f"approx_top_k_estimate(top, {top + 1})"), lambda x: x["item"].isNotNull()), 1, top).alias("frequent"))
