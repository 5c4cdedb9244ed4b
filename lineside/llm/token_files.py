"""Token ids as binary files: fixed-size blocks of ids, turned into planes, each plane compressed with zstandard.

A file is ``MAGIC``, the compressed planes of its blocks one after another, a footer, the footer's length (8 bytes) and
``MAGIC``. A block is ``block`` ids (the last one fewer). With byte planes, plane p holds byte p of every id; with
bit planes, bit p of every id, eight ids to a byte. High planes of small ids are all zero and cost a few bytes.
The footer, compressed JSON, lists for each block its number of ids, its place and the sizes of its planes (the chunk
index) and for each document its id and number of ids.

Documents lie in ascending order of ``doc_id`` (NULL first, equal ids by a hash of their text) over all files. Files
are written by tasks into the shared folder under names of their own, and only the names that a finished task returns
count, so a task that is run again leaves at most a file that nothing reads. Memory is bounded by one block, one Arrow
batch and the document table of a file; a file ends with the document at which it reaches ``file_ids`` ids.

NULL and empty texts have the end id only. Repeated rows are written as often as they occur. An empty table makes no
files. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lineside.llm.common import fresh_folder, settle, slices
from lineside.llm.tokens import encoder

MAGIC = b"IDPLANE1"
BLOCK = 65_536
FILE_IDS = 1 << 24
LEVEL = 3


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return [raw[:, p].tobytes() for p in range(4)]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(bits[:, p], bitorder="little").tobytes() for p in range(32)]


def from_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    if kind == "byte":
        raw = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in planes], axis=1)
        raw = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view("<u4").ravel()


class FileWriter:
    def __init__(self, folder: str, part: int, seq: int, block: int, kind: str):
        from pyarrow import fs

        self.store, root = fs.FileSystem.from_uri(folder)
        self.store.create_dir(root, recursive=True)
        self.name = f"{part:06d}-{seq:06d}-{uuid.uuid4().hex[:12]}.ids"
        self.out = self.store.open_output_stream(f"{root}/{self.name}")
        self.out.write(MAGIC)
        self.part, self.seq, self.block, self.kind = part, seq, block, kind
        self.at, self.total, self.held = len(MAGIC), 0, []
        self.waiting = 0
        self.blocks: list[list] = []
        self.docs: list[tuple[int | None, int]] = []
        self.pack = zstandard.ZstdCompressor(level=LEVEL)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids)))
        self.total += len(ids)
        self.held.append(ids)
        self.waiting += len(ids)
        if self.waiting >= self.block:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        flat = np.concatenate(self.held) if self.held else np.empty(0, "<u4")
        stop = len(flat) if last else len(flat) - len(flat) % self.block
        for i in range(0, stop, self.block):
            part = flat[i:min(i + self.block, stop)]
            planes = [self.pack.compress(p) for p in to_planes(part, self.kind)]
            self.blocks.append([len(part), self.at, [len(p) for p in planes]])
            for p in planes:
                self.out.write(p)
                self.at += len(p)
        self.held = [flat[stop:].copy()]
        self.waiting = len(flat) - stop

    def close(self) -> tuple:
        self._flush(True)
        footer = {"kind": self.kind, "blocks": self.blocks, "docs": [d for d, _ in self.docs],
                  "lengths": [n for _, n in self.docs]}
        raw = self.pack.compress(json.dumps(footer).encode())
        self.out.write(raw + len(raw).to_bytes(8, "little") + MAGIC)
        self.out.close()
        return self.name, self.part, self.seq, len(self.docs), self.total


def write_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, kind: str = "byte", block: int = BLOCK,
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """Write the ids of ``docs`` (doc_id, text) and return the index of files, in order by (part, seq):
    name, part, seq, n_docs, n_ids, first_id (ids in all files before)."""
    ordered = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("_tie"))
        .repartitionByRange("doc_id", "_tie")
        .sortWithinPartitions("doc_id", "_tie")
        .select("doc_id", "text")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seq, writer = encoder(tokenizer).encode, TaskContext.get().partitionId(), 0, None
        done: list[tuple] = []
        end = np.array([end_id], "<u4").tobytes()
        for piece in slices(batches, "text"):
            texts = piece.column("text").to_pylist()
            for doc_id, raw in zip(piece.column("doc_id").to_pylist(), encode(texts)):
                if writer is None:
                    writer = FileWriter(folder, part, seq, block, kind)
                    seq += 1
                writer.add(doc_id, np.frombuffer(raw + end, "<u4"))
                if writer.total >= file_ids:
                    done.append(writer.close())
                    writer = None
        if writer is not None:
            done.append(writer.close())
        names, parts, seqs, n_docs, n_ids = zip(*done) if done else ([],) * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(parts, pa.int32()), pa.array(seqs, pa.int32()),
             pa.array(n_docs, pa.int64()), pa.array(n_ids, pa.int64())],
            names=["name", "part", "seq", "n_docs", "n_ids"])

    files = settle(
        ordered.mapInArrow(write, "name string, part int, seq int, n_docs long, n_ids long"), "token-file-list")
    # Two small windows: over the files of a part, and over one row per part.
    own = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("_ids"))
    every = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("part", F.coalesce(F.sum("_ids").over(every), F.lit(0)).alias("_base"))
    return files.join(base, "part").select(
        "name", "part", "seq", "n_docs", "n_ids",
        (F.col("_base") + F.coalesce(F.sum("n_ids").over(own), F.lit(0))).alias("first_id"))


def file_documents(store, path: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """Documents of one file in order, a block at a time."""
    unpack = zstandard.ZstdDecompressor()
    with store.open_input_file(path) as f:
        size = f.size()
        f.seek(size - 16)
        tail = f.read(16)
        n = int.from_bytes(tail[:8], "little")
        if tail[8:] != MAGIC or n > size - 24:
            raise ValueError(f"not a complete token file: {path}")
        f.seek(size - 16 - n)
        footer = json.loads(unpack.decompress(f.read(n)))
        blocks, held, have = iter(footer["blocks"]), [], 0
        for doc_id, length in zip(footer["docs"], footer["lengths"]):
            while have < length:
                ids, at, sizes = next(blocks)
                f.seek(at)
                raw = f.read(sum(sizes))
                cuts = np.cumsum([0, *sizes]).tolist()
                planes = [unpack.decompress(raw[a:b]) for a, b in zip(cuts, cuts[1:])]
                held.append(from_planes(planes, ids, footer["kind"]))
                have += ids
            flat = held[0] if len(held) == 1 else np.concatenate(held) if held else np.empty(0, "<u4")
            yield doc_id, flat[:length]
            held, have = [flat[length:]], have - length


def read_files(index: DataFrame, folder: str, digest: bool = False) -> DataFrame:
    """Documents from the files of ``index``: doc_id, start, n_tokens and ids, or instead of these their CRC-32."""
    last = "ids_crc32 long" if digest else "ids array<long>"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)

        def out(rows):
            ids, starts, lengths, values = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                 pa.array(values, pa.int64() if digest else pa.list_(pa.int64()))],
                names=["doc_id", "start", "n_tokens", last.split()[0]])

        for batch in batches:
            for name, start in zip(batch.column("name").to_pylist(), batch.column("first_id").to_pylist()):
                rows, held = [], 0
                for doc_id, ids in file_documents(store, f"{root}/{name}"):
                    rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()) if digest else ids))
                    start += len(ids)
                    held += len(ids)
                    if held > 1 << 20:
                        yield out(rows)
                        rows, held = [], 0
                if rows:
                    yield out(rows)

    files = index.select("name", "first_id")
    tasks = max(1, min(10_000, files.count()))
    return files.repartition(tasks, "name").mapInArrow(read, f"doc_id long, start long, n_tokens long, {last}")


def round_trip(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int, **options) -> DataFrame:
    """Write ``docs`` to token files in the shared folder, read them back: doc_id, start, n_tokens, ids_crc32."""
    folder = fresh_folder(spark, "token-files")
    return read_files(write_files(docs, folder, tokenizer, end_id, **options), folder, digest=True)
