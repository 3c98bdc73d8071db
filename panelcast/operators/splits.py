"""Time-ordered splits: global row index, expanding folds, per-entity holdout.

The global row index must not funnel rows through one task (a window without a
partition) nor through one hot date.  Rows are range-sorted on the full ordering
key (so a hot date is split across partitions), each partition's row count is
aggregated (one row per partition) and the prefix offset is added to the
position inside the partition.  The sorted data (with its partition ids) is written
as a table under the shared checkpoint folder, so both passes see the same layout
even after executor loss.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.session import materialize


def global_row_index(df: DataFrame, order_cols: Sequence[str], out: str = "row_idx") -> DataFrame:
    s = materialize(df.orderBy(*order_cols)
                    .withColumn("_pid", F.spark_partition_id())
                    .withColumn("_mid", F.monotonically_increasing_id()), "rowidx")
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select("_pid", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"))
    # offs has one row per partition: a bounded broadcast.
    return (s.join(F.broadcast(offs), "_pid")
            .withColumn(out, (F.col("_off") + F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)).cast("long"))
            .drop("_pid", "_mid", "_off"))


def expanding_folds(indexed: DataFrame, n: int, n_splits: int = 5, idx: str = "row_idx",
                    out: str = "val_fold") -> DataFrame:
    """Expanding-window split of n ordered rows: fold k validates rows
    [n - (K-k)s, n - (K-1-k)s) with s = n // (K+1) and trains on all earlier rows.
    Rows before the first validation block get a null fold."""
    s = n // (n_splits + 1)
    start = n - n_splits * s
    if s <= 0:
        return indexed.withColumn(out, F.lit(None).cast("int"))
    f = F.floor((F.col(idx) - F.lit(start)) / F.lit(s)).cast("int")
    return indexed.withColumn(out, F.when(F.col(idx) >= start, f))


def fold_bounds(n: int, n_splits: int = 5) -> list[tuple[int, int, int]]:
    """(fold, val_start, val_end) of an expanding split."""
    s = n // (n_splits + 1)
    start = n - n_splits * s
    return [(k, start + k * s, start + (k + 1) * s) for k in range(n_splits)] if s > 0 else []


def fold_label_counts(folded: DataFrame, label: str, n_splits: int = 5,
                      fold_col: str = "val_fold") -> DataFrame:
    """Per fold: rows and positives in train (all earlier blocks) and validation."""
    blocks = (folded.groupBy(F.coalesce(F.col(fold_col), F.lit(-1)).alias("block"))
              .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("pos")))
    w = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # <= n_splits + 1 rows
    return (blocks.select(F.col("block").alias("fold"),
                          F.sum("n").over(w).alias("n_train"), F.sum("pos").over(w).alias("pos_train"),
                          F.col("n").alias("n_val"), F.col("pos").alias("pos_val"))
            .where(F.col("fold") >= 0))


def holdout_split(df: DataFrame, entity: str, order_col: str, frac: float = 0.8) -> DataFrame:
    """Chronological split per entity: the first floor(frac * n) rows are training."""
    w = Window.partitionBy(entity).orderBy(order_col)
    return (df.withColumn("rn", F.row_number().over(w))
            .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(entity)))
            .withColumn("n_train", F.floor(F.col("n") * frac).cast("int"))
            .withColumn("is_train", F.col("rn") <= F.col("n_train")))


def grouped_prefix_sums(df: DataFrame, group: str, order: str, cols: Sequence[str],
                        descending: bool = False, exclusive: bool = False) -> DataFrame:
    """Running sums of ``cols`` within each ``group`` in ``order``, computed without
    putting a whole group into one task: rows are range-sorted on (group, order), each
    partition's per-group totals give offsets (a small table), and local running
    sums are added within (partition, group) - whose size is bounded by the range
    partition, not by the group.  ``exclusive`` sums strictly earlier rows."""
    key = F.col(order).desc() if descending else F.col(order).asc()
    s = materialize(df.orderBy(F.col(group).asc(), key).withColumn("_pid", F.spark_partition_id()),
                    "prefix")
    tot = s.groupBy("_pid", group).agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    wo = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select("_pid", group, *[F.coalesce(F.sum(f"_t_{c}").over(wo), F.lit(0)).alias(f"_o_{c}")
                                       for c in cols])
    wl = Window.partitionBy("_pid", group).orderBy(key).rowsBetween(
        Window.unboundedPreceding, -1 if exclusive else 0)
    out = s.join(offs, ["_pid", group])
    return (out.withColumns({f"cum_{c}": F.col(f"_o_{c}") + F.coalesce(F.sum(c).over(wl), F.lit(0))
                             for c in cols})
            .drop("_pid", *[f"_o_{c}" for c in cols]))
