"""Change feed of a keyed table and its triggered sync into a serving copy (B12).

``record`` compares two snapshots and appends the differences as one *version*:
a folder of change rows, each with its key, ``_change`` (insert, update, delete),
``_version`` and the new values (the old ones for a delete).

``sync`` lets Structured Streaming read the folders it has not seen yet
(``availableNow``) and hands each batch to ``apply_changes``.  The copy lies in
hash buckets of the key (:mod:`mercato.plans.store`).  A batch rewrites the
buckets it has changes for and no others: their rows and the changes are grouped
by key, and the highest version of each key stays.  A deleted key stays as a
tombstone with its version, so an old insert that comes again cannot bring it
back.  Hence a batch may be repeated, or versions arrive in any order or twice:
the copy ends up the same.

Within one version a key occurs at most once (``record`` compares snapshots with
unique keys); a null key is a key like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from mercato.plans.serving import snapshot_diff
from mercato.plans.store import PART, Store, Write, bucket_of, touched_parts

CHANGE, VERSION, DELETED = "_change", "_version", "_deleted"
TABLE = "rows"


def version_folder(feed: str, version: int) -> str:
    return f"{feed}/v{version:012d}"


def record(old: DataFrame, new: DataFrame, key: list[str], feed: str, version: int) -> str:
    """Append what changed between two snapshots as a version; recording a version again replaces its folder."""
    values = [c for c in new.columns if c not in key]
    changes = snapshot_diff(old, new, key, values).select(
        *key, F.col("change_type").alias(CHANGE), F.lit(version).cast("long").alias(VERSION), *values)
    folder = version_folder(feed, version)
    changes.write.mode("overwrite").parquet(folder)
    return folder


def feed_schema(table: StructType, key: list[str]) -> StructType:
    """Columns of the change rows of a table."""
    by_name = {f.name: f for f in table.fields}
    return StructType([StructField(k, by_name[k].dataType) for k in key]
                      + [StructField(CHANGE, StringType()), StructField(VERSION, LongType())]
                      + [StructField(f.name, f.dataType) for f in table.fields if f.name not in key])


def changes(spark: SparkSession, feed: str, schema: StructType, key: list[str]) -> DataFrame:
    """All recorded versions."""
    return spark.read.schema(feed_schema(schema, key)).option("recursiveFileLookup", "true").parquet(feed)


def apply_changes(batch: DataFrame, store: Store, key: list[str], buckets: int) -> list[str]:
    """Merge change rows into the copy; returns the buckets that were rewritten."""
    values = [c for c in batch.columns if c not in (*key, CHANGE, VERSION)]
    new = batch.select(*key, *values, VERSION, (F.col(CHANGE) == "delete").alias(DELETED)).withColumn(PART, bucket_of(key, buckets))
    touched = touched_parts(new)
    if not touched:
        return []
    old = store.read(TABLE, touched)
    rows = new if old is None else new.unionByName(old.withColumn(PART, bucket_of(key, buckets)))
    rest = [*values, VERSION, DELETED]
    newest = rows.groupBy(PART, *key).agg(F.max_by(F.struct(*rest), VERSION).alias("_row"))
    store.publish({TABLE: Write(newest.select(PART, *key, *[F.col("_row")[c].alias(c) for c in rest]), touched)})
    return touched


def sync(spark: SparkSession, feed: str, store: Store, schema: StructType, key: list[str], checkpoint: str,
         buckets: int = 64) -> list[list[str]]:
    """Apply all versions not seen by this checkpoint, then stop; returns the buckets rewritten by each batch."""
    rewritten: list[list[str]] = []

    def upsert(batch: DataFrame, _: int) -> None:
        rewritten.append(apply_changes(batch, store, key, buckets))

    query = (spark.readStream.schema(feed_schema(schema, key)).option("recursiveFileLookup", "true").parquet(feed)
             .writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return rewritten


def current(store: Store) -> DataFrame | None:
    """The synced copy: newest values of every key that is not deleted."""
    rows = store.read(TABLE)
    return None if rows is None else rows.where(~F.col(DELETED)).drop(VERSION, DELETED)
