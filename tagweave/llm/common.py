"""Helpers that several of the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tagweave import session


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, and let go of the steps before it.

    Shuffle files of finished steps stay on the executors' disks until the driver happens to
    collect its garbage. A driver that only waits for jobs hardly ever does, so it is asked to.
    """
    written = session.materialize(df, name)
    df.sparkSession.sparkContext._jvm.System.gc()
    return written


def release(*written: DataFrame) -> None:
    """Delete written intermediates that nothing reads any more; what came of them must be written itself."""
    for df in written:
        spark = df.sparkSession
        own = f"{session.shared_dir(spark)}/tagweave/"
        jvm = spark._jvm
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            # Only folders that new_path has named.
            if path.getParent().toUri().getPath() == jvm.org.apache.hadoop.fs.Path(own).toUri().getPath().rstrip("/"):
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A scan of a table. Rows go to Python in batches of bounded bytes, as texts may be long."""
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(bound) == "67108864b":  # the default
        spark.conf.set(bound, BATCH_BYTES)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ragged_take(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The slices ``flat[starts[i]:starts[i] + lens[i]]``, one after the other."""
    lens = lens.astype(np.int64)
    ends = np.cumsum(lens)
    if not len(ends):
        return flat[:0]
    shift = np.repeat(starts - (ends - lens), lens)
    return flat[np.arange(ends[-1]) + shift]


def slices(batches: Iterator[pa.RecordBatch], column: int, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in parts of about ``limit`` bytes of a string column, or of list items of four bytes.

    What Python makes of a text is several times its size, so a worker holds a part at a time.
    """
    for batch in batches:
        values = batch.column(column)
        if pa.types.is_list(values.type):
            sizes = pc.multiply(pc.list_value_length(values), 4)
        else:
            sizes = pc.binary_length(values)
        for a, b in by_size(sizes.fill_null(0).to_pylist(), limit):
            yield batch.slice(a, b - a)


def by_size(sizes, limit: int):
    """Ranges of neighbouring items whose sizes add up to ``limit`` at most, or of one larger item."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)
