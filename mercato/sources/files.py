"""File sources: binary documents (A12) and table-function sources (A13)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def binary_files(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """(path, modificationTime, length, content) per file, read on the executors."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path)


def decode_text(df: DataFrame, encoding: str = "UTF-8") -> DataFrame:
    """Text of each binary file (for the field extraction operators)."""
    return df.withColumn("text", F.decode(F.col("content"), encoding))
