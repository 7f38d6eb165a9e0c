"""ST1 — incremental bronze ingest with Structured Streaming.

New Parquet files dropped into a landing folder are picked up once per
trigger, stamped with the same audit columns as the batch bronze ingest
(``_source_file`` added), and appended to the bronze table.  The checkpoint
(in the cluster's shared checkpoint folder by default) records which files
were committed, so a rerun after a failure or a second run with no new files
adds nothing: exactly-once file ingest.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.session import checkpoint_dir


def stream_bronze(spark: SparkSession, landing: str, schema, source_table: str, batch_id: str | None = None) -> DataFrame:
    """Streaming DataFrame over the landing folder with audit columns."""
    s = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1000).parquet(landing))
    return s.withColumns({"_ingested_at": F.current_timestamp(),
                          "_source_table": F.lit(source_table),
                          "_batch_id": F.lit(batch_id or "stream"),
                          "_source_file": F.col("_metadata.file_path")})


def ingest(spark: SparkSession, landing: str, target: str, schema, source_table: str,
           checkpoint: str | None = None, batch_id: str | None = None) -> dict:
    """Process every file not yet ingested (``availableNow``), then stop.

    Returns progress numbers of the run (rows and files of this run).
    """
    ckpt = checkpoint or os.path.join(target.rstrip("/") + "_checkpoint")
    q = (stream_bronze(spark, landing, schema, source_table, batch_id).writeStream
         .format("parquet").option("path", target).option("checkpointLocation", ckpt)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    rows = sum(int(p.get("numInputRows", 0)) for p in q.recentProgress)
    return {"rows": rows, "batches": len([p for p in q.recentProgress if p.get("numInputRows", 0)])}


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "mercato-scratch", f"{name}-{uuid.uuid4().hex[:12]}")


def drop_files(df: DataFrame, landing: str, split_col: str, boundaries: list) -> list[str]:
    """Write ``df`` as successive file drops cut at the given ``split_col`` values; nulls go to the first."""
    paths = []
    edges = [None, *boundaries, None]
    for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        part = df
        if lo is not None:
            part = part.where(F.col(split_col) >= F.lit(lo))
        if hi is not None:
            early = F.col(split_col) < F.lit(hi)
            part = part.where(early if lo is not None else early | F.col(split_col).isNull())
        p = os.path.join(landing, f"drop={i:04d}")
        part.write.mode("overwrite").parquet(p)
        paths.append(p)
    return paths
