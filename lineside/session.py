"""Session settings and the shared scratch folder."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


LOCAL_ROOT = "/tmp/checkpoints"
_COALESCED = "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"
_setting = threading.Lock()


def build_session(app: str = "lineside", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings that the results rely on; anything else is left to the cluster."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # No call site per column expression: that costs more than the planning itself.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def sized_for(input_bytes: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings that keep scan and shuffle partitions at about ``partition_bytes`` for an input.

    Shuffles start out fine-grained and adaptive execution joins small partitions, so an estimate that is
    too high costs little; one that is too low spills.
    """
    partitions = max(200, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
    }


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor can reach.

    Only a local session, where the driver is the only machine, may go without one; it gets ``LOCAL_ROOT``.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = LOCAL_ROOT
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def held(rows: DataFrame) -> DataFrame:
    """Persist ``rows`` in as many partitions as they fill.

    By itself a persisted frame keeps every shuffle partition, however small, and each of them hands on a piece to each
    partition of the next shuffle: 200 times 200 files for a few thousand rows.
    """
    conf = rows.sparkSession.conf
    with _setting:
        before = conf.get(_COALESCED)
        conf.set(_COALESCED, "true")
        try:
            return rows.persist()
        finally:
            conf.set(_COALESCED, before)


def local_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A few driver-side rows as a local relation, which needs no job and folds away when empty."""
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    arrow = to_arrow_schema(schema)
    arrays = [pa.array(list(values), type=f.type) for values, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema)
