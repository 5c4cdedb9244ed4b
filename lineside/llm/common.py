"""Shared pieces of the operators: settled intermediate tables, let-bound columns, hashed words.

A word is a maximal run of bytes other than space and the control characters 9 to 13.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The characters between words, as a regular expression class and as a translate() list.
BLANKS = r"[\x20\x09-\x0D]+"
BLANK_CHARS = " \t\n\x0b\f\r"
LOCAL_ROOT = "/tmp/checkpoints"


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; a local session without one gets its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = LOCAL_ROOT
    return root.rstrip("/")


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:16]}"


def settle(frame: DataFrame, name: str) -> DataFrame:
    """Write ``frame`` to the shared folder and read it back: lineage ends here and survives lost executors."""
    path = fresh_folder(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def unused(name: str, frame: DataFrame) -> str:
    """``name``, longer where ``frame`` has a column of that name."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` but for rows whose ``doc_id`` is among those of ``gone``."""
    key = unused("gone", docs)
    return docs.join(gone.select(F.col("doc_id").alias(key)).distinct(), F.col("doc_id") == F.col(key), "left_anti")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often a lambda inside ``body`` reads it."""
    return F.transform(F.array(value), body)[0]


# ---- words of Arrow text columns, hashed without a Python loop over words ----

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))
SLICE_BYTES = 1 << 20
_powers: dict[str, np.ndarray] = {}
_space = np.zeros(256, bool)
_space[[32, *range(9, 14)]] = True
_plain = np.random.default_rng(20260101).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_lower = _plain.copy()
_lower[65:91] = _plain[97:123]


def _power_table(base: np.uint64, n: int) -> np.ndarray:
    key = str(base)
    if key not in _powers or len(_powers[key]) < n:
        table = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        table[0] = 1
        _powers[key] = np.multiply.accumulate(table)
    return _powers[key][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and where each begins (one more entry than texts); NULL is empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None and len(column) else np.empty(0, np.uint8)
    return raw, at - at[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = text_bytes(batch.column(text))
        row = 0
        while row < batch.num_rows:
            stop = max(row + 1, int(np.searchsorted(at, at[row] + limit, "right")) - 1)
            yield batch.slice(row, stop - row)
            row = stop


def runs(kind: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of equal non-zero ``kind`` that stay inside one text.

    Returns where each begins and ends, and for each text the number of its first run (one entry more).
    """
    n = len(kind)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(at), np.int64)
    edge = np.empty(n, bool)
    edge[0] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:])
    edge[at[:-1][at[:-1] < n]] = True
    begin = np.flatnonzero(edge)
    end = np.append(begin[1:], n)
    keep = kind[begin] != 0
    begin, end = begin[keep], end[keep]
    return begin, end, np.searchsorted(begin, at)


def words(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return runs((~_space[raw]).view(np.uint8), at)


def hashes(raw: np.ndarray, begin: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each byte range, from prefix sums of a polynomial over the ring of 64-bit integers.

    ``lower`` folds A-Z to a-z. Equal bytes give equal hashes; different ones differ but for a chance of 2^-64.
    """
    table = _lower if lower else _plain
    sums = np.empty(len(raw) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(table[raw] * _power_table(MULTIPLIER, len(raw)), out=sums[1:])
    back = _power_table(INVERSE, len(raw) + 1)
    return mix((sums[end] - sums[begin]) * back[begin] + (end - begin).astype(np.uint64))


def spans(h: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each range of neighbours, whatever its length; equal sequences of hashes give equal ones."""
    sums = np.empty(len(h) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(h * _power_table(MULTIPLIER, len(h)), out=sums[1:])
    return mix((sums[end] - sums[begin]) * _power_table(INVERSE, len(h) + 1)[begin] + (end - begin).astype(np.uint64))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` neighbours; none if there are fewer than ``k``."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = h[:n].copy()
    for j in range(1, k):
        out = out * MULTIPLIER + h[j:j + n]
    return mix(out)


def ship(spark: SparkSession) -> None:
    """Make this package importable on the workers of a session that was started without it on their path."""
    context = spark.sparkContext
    if getattr(context, "_lineside_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    path = Path(tempfile.mkdtemp(prefix="lineside-code-")) / "lineside_code.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(str(path))  # Spark's own file server hands it to the executors
    context._lineside_shipped = True
