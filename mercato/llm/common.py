"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from mercato.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the cluster's checkpoint folder and read from there.

    Cuts the lineage, so that later passes read files that every executor can
    reach instead of computing the upstream stages again.  Nothing reads the step's
    shuffles after that, so their files go at once, not when the driver next happens to
    collect garbage: a job of many steps would keep the shuffles of all of them.
    """
    checkpoint_dir(df.sparkSession)
    return let_go(df).checkpoint(eager=True)


_LET_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def let_go(df: DataFrame) -> DataFrame:
    """``df`` as a plan of its own, whose shuffle files Spark deletes when an action on it ends."""
    conf = df.sparkSession.conf
    before = conf.get(_LET_GO)
    conf.set(_LET_GO, "true")
    try:
        return df.select("*")  # a plan takes the setting up when it is made
    finally:
        conf.set(_LET_GO, before)


def one_row(df: DataFrame) -> Row:
    """The row of a table of one row."""
    return let_go(df).collect()[0]


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder of an operator's own intermediate table."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def crc_of_id(doc_id: Column) -> Column:
    """crc32 of the id as text; the remainder of it deals documents into folds."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows whose ``column`` holds about ``most_bytes``.

    Bounds a task's working memory when texts are very long; a single row is
    never cut.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        sizes = pa.compute.fill_null(pa.compute.binary_length(col), 0).to_pylist()
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > most_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a batch; null is the empty text."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]


_STEP = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scattering of 64-bit words."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(33))


class Spans:
    """64-bit hashes of any spans of a sequence, from prefix sums of a polynomial."""

    def __init__(self, codes: np.ndarray):
        n = codes.size + 1
        powers, inverse = np.full(n, _STEP, np.uint64), np.full(n, pow(_STEP, -1, 1 << 64), np.uint64)
        powers[0] = inverse[0] = 1
        self.inverse = np.multiply.accumulate(inverse)
        self.sums = np.zeros(n, np.uint64)
        letters = mix(np.arange(1, 257, dtype=np.uint64))[codes] if codes.dtype == np.uint8 else mix(codes.astype(np.uint64) + np.uint64(1))
        np.cumsum(letters * np.multiply.accumulate(powers)[:-1], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts])
