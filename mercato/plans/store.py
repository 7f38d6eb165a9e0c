"""Tables in parts behind one pointer.

A store holds named tables, each cut into parts (months, hash buckets).  Every
write goes to a folder of its own; a numbered listing says which folders make up
which part.  Readers follow the newest listing, so a write becomes visible with
all its tables at once, by one rename, or not at all.  Parts that a write does
not name keep their folders: nothing of them is read or written.

The listing has one line per part and folder.  It is the only thing that goes
through the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PART = "_part"


@dataclass
class Write:
    """Rows for the ``touched`` parts of a table: in their place, or added to what is there.

    ``rows`` may be a function of the draft listing, for rows made from tables that the same publish wrote before.
    """

    rows: DataFrame | Callable[[dict], DataFrame]
    touched: list[str]
    append: bool = False


def _without_part(rows: DataFrame) -> StructType:
    return StructType([f for f in rows.schema.fields if f.name != PART])


@dataclass
class Staged:
    """Rows on disk that the listing does not name."""

    store: Store
    folders: dict[str, str]
    schema: StructType

    def publish(self, tables: dict[str, tuple[str, list[str]]], mark: str | None = None) -> None:
        """Each table becomes one staged part, without the named columns."""
        new = self.store._next(mark)
        if new is None:
            return
        for table, (part, hidden) in tables.items():
            schema = StructType([f for f in self.schema.fields if f.name not in hidden])
            parts = {part: [self.folders[part]]} if part in self.folders else {}
            new["tables"][table] = {"schema": schema.jsonValue(), "parts": parts}
        self.store._switch(new)

    def discard(self) -> None:
        for folder in self.folders.values():
            self.store._fs().delete(self.store._path(folder), True)


class Store:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self._conf = spark._jsc.hadoopConfiguration()

    # -- the listing -------------------------------------------------------------------

    def _path(self, *names: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.base, *names]))

    def _fs(self):
        return self._path().getFileSystem(self._conf)

    def version(self) -> int:
        """Number of the newest listing; 0 before the first write."""
        folder, fs = self._path("_listing"), self._fs()
        if not fs.exists(folder):
            return 0
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return max((int(n[:-5]) for n in names if n.endswith(".json")), default=0)

    def listing(self, version: int | None = None) -> dict:
        n = self.version() if version is None else version
        if n == 0:
            return {"version": 0, "tables": {}, "marks": []}
        stream = self._fs().open(self._path("_listing", f"{n}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _switch(self, listing: dict) -> None:
        """Make the listing the newest one; fails when another writer was first."""
        jvm, fs = self.spark._jvm, self._fs()
        fs.mkdirs(self._path("_listing"))
        draft, final = self._path("_listing", f".{uuid.uuid4().hex}"), self._path("_listing", f"{listing['version']}.json")
        out = fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(listing).encode()))
        finally:
            out.close()
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self._conf)
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        files.rename(draft, final, none)  # throws when the target is there already

    # -- reading -----------------------------------------------------------------------

    def marks(self) -> list[str]:
        """Names of the writes that took effect."""
        return self.listing()["marks"]

    def parts(self, table: str) -> list[str]:
        return sorted(self.listing()["tables"].get(table, {"parts": {}})["parts"])

    def read(self, table: str, parts: list[str] | None = None, listing: dict | None = None) -> DataFrame | None:
        """The current rows, of the named parts or of all; None before the table's first write."""
        entry = (listing or self.listing())["tables"].get(table)
        if entry is None:
            return None
        chosen = entry["parts"] if parts is None else {p: entry["parts"][p] for p in parts if p in entry["parts"]}
        folders = [f"{self.base}/{f}" for fs in chosen.values() for f in fs]
        schema = StructType.fromJson(entry["schema"])
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    # -- writing -----------------------------------------------------------------------

    def _next(self, mark: str | None) -> dict | None:
        """Draft of the next listing; None if the mark took effect before."""
        old = self.listing()
        if mark is not None and mark in old["marks"]:
            return None
        return {"version": old["version"] + 1, "tables": dict(old["tables"]), "marks": old["marks"] + ([mark] if mark else [])}

    def _write(self, table: str, version: int, rows: DataFrame) -> dict[str, str]:
        """Rows in a folder of their own; gives the folder of each part."""
        if PART not in rows.columns:
            raise ValueError(f"rows of {table} have no column {PART}")
        folder = f"{version:06d}-{uuid.uuid4().hex[:8]}"
        rows.write.partitionBy(PART).parquet(f"{self.base}/{table}/{folder}")
        names = [s.getPath().getName() for s in self._fs().listStatus(self._path(table, folder))]
        return {n[len(PART) + 1:]: f"{table}/{folder}/{n}" for n in names if n.startswith(f"{PART}=")}

    def publish(self, writes: dict[str, Write], mark: str | None = None) -> None:
        """Write all tables, then switch the listing; ``mark`` names the write, and a mark takes effect once."""
        new = self._next(mark)
        if new is None:
            return
        for table, w in writes.items():
            # files of even size: small parts put together, large ones split
            rows = w.rows if isinstance(w.rows, DataFrame) else w.rows(new)
            folders = self._write(table, new["version"], rows.hint("rebalance", PART))
            strange = sorted(folders.keys() - set(w.touched))
            if strange:
                raise ValueError(f"rows of {table} lie in parts {strange}, which the write does not name")
            parts = dict(new["tables"].get(table, {"parts": {}})["parts"])
            if not w.append:
                for p in w.touched:
                    parts.pop(p, None)
            for part, folder in folders.items():
                parts[part] = [*parts.get(part, []), folder]
            new["tables"][table] = {"schema": _without_part(rows).jsonValue(), "parts": parts}
        self._switch(new)

    def stage(self, table: str, rows: DataFrame) -> Staged:
        """Write rows that no reader sees yet; what is published of them is decided afterwards."""
        return Staged(self, self._write(table, self.version() + 1, rows), _without_part(rows))

    def vacuum(self, keep: int = 1) -> int:
        """Delete what neither the newest listing nor the ``keep`` before it needs; returns how many folders went.

        Folders newer than the newest listing belong to a write under way and stay.
        """
        fs, newest, gone = self._fs(), self.version(), 0
        kept = range(max(1, newest - keep), newest + 1)
        folders = {f.rsplit("/", 1)[0] for v in kept for t in self.listing(v)["tables"].values() for fs_ in t["parts"].values() for f in fs_}
        for table in {f.split("/")[0] for f in folders}:
            for status in fs.listStatus(self._path(table)):
                name = status.getPath().getName()
                if f"{table}/{name}" not in folders and int(name.split("-")[0]) <= newest:
                    fs.delete(status.getPath(), True)
                    gone += 1
        for status in fs.listStatus(self._path("_listing")):
            name = status.getPath().getName()
            if name.endswith(".json") and int(name[:-5]) not in kept:
                fs.delete(status.getPath(), False)
        return gone


def touched_parts(rows: DataFrame) -> list[str]:
    """The parts that rows fall into; as many as there are months or buckets."""
    return sorted(r[0] for r in rows.select(F.col(PART).cast("string")).distinct().collect())


def bucket_of(key: list[str], buckets: int):
    """Hash bucket of a key as a part name."""
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("string")
