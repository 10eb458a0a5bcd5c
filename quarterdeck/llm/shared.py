"""Helpers of the operators: stored intermediate tables and Arrow batches."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.operators.skew import free_name, may_hold  # noqa: F401  (used by the modules beside this one)

# Long loops over a batch work on slices of about this many characters, so that
# numpy's temporary arrays stay small whatever a batch holds.
SLICE_CHARS = 1 << 20


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder in the checkpoint folder all executors share; removed when the driver ends.

    Without ``spark.checkpoint.dir`` a local folder serves, on one machine only.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        shared = os.path.join(tempfile.gettempdir(), "quarterdeck")
    path = f"{shared}/{name}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """The frame written to the shared folder and read back: its lineage ends there.

    Lost executors cost nothing that is in the table, and steps that use it twice
    read it instead of computing it again.
    """
    path = scratch(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(column: str):
    return F.coalesce(F.col(column), F.lit(""))


def one_row_each(rows: DataFrame, key: str, *columns: str) -> DataFrame:
    """(key, columns): of the rows that share a key the one whose ``columns`` have the smallest hash.

    A key's rows are reduced where they lie before they are moved.
    """
    least = rows.groupBy(key).agg(F.min_by(F.struct(*columns), F.xxhash64(*columns)).alias("_row"))
    return least.select(key, *(F.col("_row")[c].alias(c) for c in columns))


def pair_slices(texts: Sequence[str], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of at most ``limit`` characters each, or one longer text."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


class RowBuffer:
    """Rows gathered column by column and handed out as Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema, limit_bytes: int = 4 << 20, limit_rows: int = 20_000):
        self.schema, self.limit_bytes, self.limit_rows = schema, limit_bytes, limit_rows
        self._reset()

    def _reset(self) -> None:
        self.columns: list[list] = [[] for _ in self.schema]
        self.size = 0

    def add(self, *values, size: int = 0) -> None:
        for column, value in zip(self.columns, values, strict=True):
            column.append(value)
        self.size += size

    def full(self) -> bool:
        return self.size >= self.limit_bytes or len(self.columns[0]) >= self.limit_rows

    def take(self) -> Iterable[pa.RecordBatch]:
        """The rows so far as at most one batch; the buffer is empty afterwards."""
        if not self.columns[0]:
            return []
        arrays = [pa.array(c, f.type) for c, f in zip(self.columns, self.schema, strict=True)]
        self._reset()
        return [pa.RecordBatch.from_arrays(arrays, schema=self.schema)]
