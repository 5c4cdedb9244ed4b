"""A mutable table kept as parquet parts, for a catalog without MERGE.

Rows are spread over named parts. A batch rewrites only the parts it touches, each under a folder of that
batch, and then commits by writing one small file that lists the current folder of every part. Readers
follow the newest commit, so a batch that dies before its commit leaves no trace and is simply run again.
Older commits stay readable, which gives the before-image of a batch. With a lakehouse table format its
own merge takes the place of this module.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineside import schemas as S
from lineside.session import local_rows

ENTRY = S.fields(part=S.STRING, version=S.LONG, row_count=S.LONG)
LOG = T.StructType(ENTRY.fields + S.fields(batch=S.LONG).fields)
EMPTY = -1  # version of the marker row that keeps a commit of an empty table visible


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def stream_id(batch: DataFrame) -> str:
    """The id that a streaming query keeps in its checkpoint, asked for inside ``foreachBatch``."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


class Folders:
    """Names and removal of the folders below a path, on whatever file system it is."""

    def __init__(self, spark: SparkSession, path: str):
        self._make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.path = path
        self._fs = self._make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def names(self, below: str, prefix: str) -> list[str]:
        found = [f.getPath().getName() for f in self._fs.listStatus(self._make(f"{self.path}/{below}"))]
        return [n.removeprefix(prefix) for n in found if n.startswith(prefix)]

    def drop(self, folder: str) -> None:
        self._fs.delete(self._make(f"{self.path}/{folder}"), True)


class Numbers:
    """One rising number for each batch of each stream that writes the same tables.

    Spark counts the batches of a checkpoint from 0, so a second checkpoint repeats the numbers of the first one.
    A batch that runs again gets the number it had; anything a stream has not brought yet gets the next free one.
    """

    SCHEMA = S.fields(stream=S.STRING, batch=S.LONG, number=S.LONG)

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._newest: dict[str, tuple[int, int]] | None = None

    def _known(self) -> dict[str, tuple[int, int]]:
        """Newest batch and number of each stream: one row per checkpoint ever used."""
        if self._newest is None:
            try:
                rows = self.spark.read.schema(self.SCHEMA).parquet(f"{self.path}/number=*")
                newest = rows.groupBy("stream").agg(F.max("batch").alias("batch"), F.max("number").alias("number")).collect()
            except AnalysisException as e:
                if "PATH_NOT_FOUND" not in (e.getCondition() or ""):
                    raise
                newest = []
            self._newest = {r.stream: (r.batch, r.number) for r in newest}
        return self._newest

    def of(self, batch: DataFrame, batch_id: int) -> int | None:
        """The number of a batch inside ``foreachBatch``; None if its stream has gone past it."""
        stream, known = stream_id(batch), self._known()
        last, number = known.get(stream, (-1, -1))
        if batch_id <= last:
            return number if batch_id == last else None
        number = max((n for _, n in known.values()), default=-1) + 1
        (local_rows(self.spark, [(stream, batch_id, number)], self.SCHEMA).coalesce(1)
         .write.mode("overwrite").parquet(f"{self.path}/number={number}"))
        known[stream] = (batch_id, number)
        return number

    def expire(self) -> int:
        """Drop all but the newest number of each stream; returns how many."""
        kept = {n for _, n in self._known().values()}
        if not kept:
            return 0
        folders = Folders(self.spark, self.path)
        old = [n for n in folders.names("", "number=") if int(n) not in kept]
        for n in old:
            folders.drop(f"number={n}")
        return len(old)


def hash_part(*keys: str, parts: int) -> Callable[[], Column]:
    """Spread rows evenly over ``parts`` by a hash of their key."""
    return lambda: F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("string")


def day_part(at: str, *keys: str, parts: int = 1, days: int = 1) -> Callable[[], Column]:
    """One part per day, split further by a hash of ``keys`` where a day is too large for one.

    Where a day is too small, a part takes ``days`` of them and is named by its first day.
    """
    def column() -> Column:
        date = F.col(at).cast("date")
        if days > 1:
            date = F.date_sub(date, F.pmod(F.unix_date(date), F.lit(days)))
        day = F.coalesce(date.cast("string"), F.lit("none"))
        if parts == 1:
            return day
        return F.concat(day, F.lit("-"), F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("string"))
    return column


class PartedTable:
    """One mutable table. Commits are made by one writer at a time, as by one streaming query."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, part: Callable[[], Column]):
        self.spark, self.path, self.schema, self.part = spark, path.rstrip("/"), schema, part
        self._snapshots: dict[int, dict[str, tuple[int, int]]] = {}
        self._batches: list[int] | None = None

    def _log(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(LOG).parquet(f"{self.path}/log")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in (e.getCondition() or ""):
                return None
            raise

    def batches(self) -> list[int]:
        """Numbers of the committed batches."""
        if self._batches is None:
            log = self._log()
            found = [] if log is None else log.select("batch").distinct().collect()
            self._batches = sorted(r.batch for r in found)
        return self._batches

    def committed(self, batch: int) -> bool:
        return batch in self.batches()

    def snapshot(self, before: int | None = None) -> dict[str, tuple[int, int]]:
        """Folder and row count of every part, now or as it was before a batch."""
        known = [b for b in self.batches() if before is None or b < before]
        if not known:
            return {}
        batch = known[-1]
        if batch not in self._snapshots:
            rows = self._log().where((F.col("batch") == batch) & (F.col("version") != EMPTY)).collect()
            self._remember(batch, {r.part: (r.version, r.row_count) for r in rows})
        return self._snapshots[batch]

    def _remember(self, batch: int, parts: dict[str, tuple[int, int]]) -> None:
        self._snapshots[batch] = parts
        for old in sorted(self._snapshots)[:-2]:
            del self._snapshots[old]

    def read(self, parts: Iterable[str] | None = None, before: int | None = None) -> DataFrame:
        """Rows of some or all parts, now or as they were before a batch."""
        current = self.snapshot(before)
        wanted = current if parts is None else [p for p in parts if p in current]
        paths = [f"{self.path}/data/v={current[p][0]}/_part={p}" for p in sorted(wanted)]
        if not paths:
            return local_rows(self.spark, [], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def parts_of(self, *frames: DataFrame) -> set[str]:
        """Names of the parts that some rows belong to: at most as many as the table has parts.

        Each task hands on one row with its names.
        """
        found: set[str] = set()
        for frame in frames:
            found.update(frame.agg(F.collect_set(self.part())).first()[0])
        return found

    def replace(self, rows: DataFrame, touched: Iterable[str], batch: int) -> tuple[int, int]:
        """Make ``rows`` the whole content of the touched parts; returns rows written and rows replaced.

        The rebalance hint gathers each part into few files and splits a part that is too large.
        """
        if self.batches() and batch <= self.batches()[-1]:
            raise ValueError(
                f"batch {batch} after batch {self.batches()[-1]} of {self.path}: a stream that stopped inside a batch has to "
                "finish it before another stream writes the same tables")
        touched, old = set(touched), self.snapshot()
        folder = f"{self.path}/data/v={batch}"
        (rows.select(*self.schema.names).withColumn("_part", self.part())
         .hint("rebalance", "_part")
         .write.mode("overwrite").partitionBy("_part").parquet(folder))
        written = self.spark.read.schema(T.StructType(self.schema.fields + S.fields(_part=S.STRING).fields))
        counts = {r["_part"]: r["count"] for r in written.parquet(folder).groupBy("_part").count().collect()}
        stray = set(counts) - touched
        if stray:
            raise ValueError(f"rows outside the touched parts: {sorted(stray)[:5]}")
        now = {p: v for p, v in old.items() if p not in touched}
        now.update({p: (batch, n) for p, n in counts.items()})
        entries = [(p, v, n) for p, (v, n) in now.items()] or [("", EMPTY, 0)]
        (local_rows(self.spark, entries, ENTRY).coalesce(1)
         .write.mode("overwrite").parquet(f"{self.path}/log/batch={batch}"))
        self._batches = [*self.batches(), batch]
        self._remember(batch, now)
        return sum(counts.values()), sum(n for p, (_, n) in old.items() if p in touched)

    def expire(self, keep: int = 2) -> int:
        """Drop what only older commits refer to, and leftovers of batches that died; returns folders dropped.

        ``keep`` of two or more leaves the before-image of the newest batch. Old commits go first, so that
        no reader finds a commit whose folders are gone.
        """
        if keep < 2:
            raise ValueError("keep at least two commits: the newest one and its before-image")
        kept = self.batches()[-keep:]
        if not kept:
            return 0
        rows = self._log().where(F.col("batch").isin(kept)).select("version", "part").distinct().collect()
        wanted = {(r.version, r.part) for r in rows}
        live = {version for version, _ in wanted}
        folders = Folders(self.spark, self.path)
        for batch in folders.names("log", "batch="):
            if int(batch) < kept[0]:
                folders.drop(f"log/batch={batch}")
        self._batches = kept
        dropped = 0
        for version in folders.names("data", "v="):
            if int(version) > kept[-1]:
                continue
            gone = [p for p in folders.names(f"data/v={version}", "_part=") if (int(version), p) not in wanted]
            for part in gone if int(version) in live else []:
                folders.drop(f"data/v={version}/_part={part}")
            if int(version) not in live:
                folders.drop(f"data/v={version}")
            dropped += len(gone)
        return dropped


class RunLog:
    """One row per table and batch: what a refresh did. A batch that runs again replaces its rows, but for failures."""

    SCHEMA = S.fields(
        batch_id=S.LONG, name=S.STRING, started_at=S.NTZ, seconds=S.DOUBLE, action=S.STRING, state=S.STRING,
        mode=S.STRING, reason=S.STRING, rows_affected=S.LONG, rows_inserted=S.LONG, rows_deleted=S.LONG,
        data_timestamp=S.NTZ, merges=S.LONG, rows_total=S.LONG)

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._totals: tuple[int, int] | None = None

    def read(self) -> DataFrame:
        try:
            return self.spark.read.schema(self.SCHEMA).parquet(f"{self.path}/*=*")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in (e.getCondition() or ""):
                return local_rows(self.spark, [], self.SCHEMA)
            raise

    def totals(self, before: int) -> tuple[int, int]:
        """Merges and rows merged so far; read once, then kept, as one writer appends in order."""
        if self._totals is None:
            row = self.read().where(F.col("batch_id") < before).agg(F.max("merges"), F.max("rows_total")).first()
            self._totals = (row[0] or 0, row[1] or 0)
        return self._totals

    def write(self, batch: int, entries: list[dict]) -> None:
        merges, total = self.totals(batch)
        rows = []
        for e in entries:
            if e["action"] == "MERGE":
                merges, total = merges + 1, total + e["rows_affected"]
            filled = {"batch_id": batch, "state": "SUCCEEDED", "mode": "INCREMENTAL", "reason": "",
                      "data_timestamp": e["started_at"], "merges": merges, "rows_total": total, **e}
            rows.append(tuple(filled.get(n) for n in self.SCHEMA.names))
        self._totals = (merges, total)
        self._put(rows, f"run={batch}")

    @contextmanager
    def watch(self, name: str, action: str, batch: int) -> Iterator[None]:
        """Log a layer that fails, with its error as the reason, and let the error go on."""
        started = utc_now()
        try:
            yield
        except Exception as error:
            merges, total = self.totals(batch)
            row = {"batch_id": batch, "name": name, "started_at": started, "seconds": (utc_now() - started).total_seconds(),
                   "action": action, "state": "FAILED", "mode": "INCREMENTAL",
                   "reason": f"{type(error).__name__}: {error}".splitlines()[0][:500], "data_timestamp": started,
                   "merges": merges, "rows_total": total}
            self._put([tuple(row.get(n) for n in self.SCHEMA.names)], f"failed={batch}-{uuid.uuid4().hex[:12]}")
            raise

    def _put(self, rows: list[tuple], folder: str) -> None:
        (local_rows(self.spark, rows, self.SCHEMA).coalesce(1)
         .write.mode("overwrite").parquet(f"{self.path}/{folder}"))
