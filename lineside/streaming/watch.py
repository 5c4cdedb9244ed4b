"""What Spark reports of streaming refreshes, kept as a table: every batch with the newest data it brought, every failure."""

from __future__ import annotations

import threading
from datetime import datetime

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from lineside import schemas as S
from lineside.functions.times import Stamp, seconds_between, stamp
from lineside.session import local_rows

REFRESHES = S.fields(
    name=S.STRING, run_id=S.STRING, batch_id=S.LONG, reported_at=S.NTZ, state=S.STRING, rows_read=S.LONG, elapsed_ms=S.LONG,
    data_timestamp=S.NTZ, reason=S.STRING)
OBSERVED = "refresh"


def watched(rows: DataFrame, at: Stamp) -> DataFrame:
    """A stream whose batches report the newest time they hold."""
    return rows.observe(OBSERVED, F.max(stamp(at)).alias("data_timestamp"))


class RefreshListener(StreamingQueryListener):
    """Takes down each batch and each failure of the session's named queries, and appends them to a table on ``flush``.

    Between two flushes it holds one short row per batch.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self._rows: list[tuple] = []
        self._names: dict[str, str] = {}
        self._ended: set[str] = set()
        self._news = threading.Condition()

    def onQueryStarted(self, event) -> None:
        self._names[str(event.runId)] = event.name

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if not p.numInputRows:
            return
        seen = p.observedMetrics.get(OBSERVED)
        at = datetime.fromisoformat(p.timestamp.replace("Z", "")).replace(tzinfo=None)
        with self._news:
            self._rows.append((
                p.name, str(p.runId), p.batchId, at, "SUCCEEDED", p.numInputRows, p.durationMs.get("triggerExecution"),
                seen["data_timestamp"] if seen else None, None))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        with self._news:
            if event.exception:
                reason = event.exception.strip().split("\n")[0][:500]
                self._rows.append((self._names.get(run), run, None, None, "FAILED", None, None, None, reason))
            self._ended.add(run)
            self._news.notify_all()

    def drained(self, query: StreamingQuery, seconds: float = 60) -> bool:
        """Wait for a query to end and for all its reports; says whether it ended well."""
        well = True
        try:
            query.awaitTermination()
        except StreamingQueryException:
            well = False
        with self._news:
            if not self._news.wait_for(lambda: str(query.runId) in self._ended, seconds):
                raise TimeoutError(f"no report of the end of {query.name}")
        return well

    def flush(self) -> None:
        with self._news:
            rows, self._rows = self._rows, []
        if rows:
            local_rows(self.spark, rows, REFRESHES).coalesce(1).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(REFRESHES).parquet(self.path)


def refresh_report(log: DataFrame, as_of: Stamp) -> DataFrame:
    """Refreshes, failures and lag in seconds of each table; a table that never succeeded has no lag."""
    done = F.col("state") == "SUCCEEDED"
    newest = F.max(F.when(done, F.col("data_timestamp")))
    return log.groupBy("name").agg(
        F.count_if(done).alias("succeeded"), F.count_if(F.col("state") == "FAILED").alias("failed"), newest.alias("newest_data"),
    ).withColumn("lag_secs", seconds_between("newest_data", as_of))
