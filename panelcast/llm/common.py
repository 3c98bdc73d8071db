"""Small helpers the operators share."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.session import ensure_checkpoint_dir, materialize

__all__ = ["prepare", "materialize", "docs_table", "ids_and_text", "arrow_map", "slices", "texts",
           "mix64", "text_key", "LOWEST", "column_of", "ASCII_LOWER"]

#: Stands for a null doc_id in keys and orders before every other id.
LOWEST = -(2 ** 63)
#: Byte table that lower-cases A-Z and nothing else.
ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def prepare(spark: SparkSession) -> None:
    """Session settings the operators rely on: a shared checkpoint folder, small Arrow
    batches (long texts), and shuffle files dropped when the query that made them ends
    (what later queries need is written to the shared folder)."""
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def docs_table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ids_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (as bigint) and the text, so that further columns never clash."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def text_key(text: str | None) -> int:
    """32-bit key that tells texts with the same doc_id apart (null: 0)."""
    return 0 if text is None else zlib.crc32(text.encode("utf-8", "surrogatepass"))


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def column_of(batch: pa.RecordBatch, name: str):
    return batch.column(batch.schema.get_field_index(name))


def slices(batches: Iterator[pa.RecordBatch], max_bytes: int = 3 << 19, text_col: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``max_bytes`` of text (or one longer row)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        lengths = column_of(batch, text_col)
        size = np.asarray(pc.binary_length(lengths).fill_null(0), dtype=np.int64)
        total = np.cumsum(size)
        start, done = 0, 0
        while start < n:
            end = max(start + 1, int(np.searchsorted(total, done + max_bytes, side="right")))
            yield batch.slice(start, end - start)
            done, start = int(total[end - 1]), end


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str | None]:
    return column_of(batch, name).to_pylist()


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finalizer (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
