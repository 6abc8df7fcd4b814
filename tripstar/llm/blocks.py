"""Text blocks: how the operators read documents and meet each other.

* :func:`iter_blocks` cuts an Arrow batch into blocks of about one MB of text
  (a longer document is a block of its own), so that numpy work inside a task
  has a memory bound that does not depend on the batch size.
* :func:`stage_parts` writes a table once as compressed blocks, bucketed by
  ``part``: a stretch of one scan task's rows of at most ``PART_BYTES`` of text
  (or one longer document).  Later passes read that table and meet small
  per-part tables in a co-group on ``part``: the staged side is already
  bucketed, so the texts themselves are never shuffled, and a Python task holds
  one part whatever the size of the scan split.
"""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.session import scratch_path

BLOCK_BYTES = 1 << 20
BLOCK_ROWS = 2_000
BATCH_ROWS = 1_000  # rows that travel to a Python worker at once
PART_BYTES = 16 << 20
PARTS_PER_TASK = 1000
PART_SCHEMA = ("part int, seq int, ids binary, id_null binary, lens binary, "
               "text_null binary, payload binary, rest binary")


@dataclass
class Block:
    """Consecutive documents: ids (0 where null), byte lengths, one buffer."""

    ids: np.ndarray
    id_null: np.ndarray
    lens: np.ndarray
    text_null: np.ndarray
    data: bytes

    @property
    def offsets(self) -> np.ndarray:
        out = np.zeros(len(self.lens) + 1, dtype=np.int64)
        np.cumsum(self.lens, out=out[1:])
        return out

    def texts(self) -> list[bytes]:
        o = self.offsets
        return [self.data[o[i]:o[i + 1]] for i in range(len(self.lens))]

    def id_list(self) -> list[int | None]:
        return [None if n else int(i) for i, n in zip(self.ids, self.id_null)]


def _block(ids, texts) -> Block:
    data = [b"" if t is None else t for t in texts]
    return Block(
        np.array([0 if i is None else i for i in ids], dtype=np.int64),
        np.array([i is None for i in ids], dtype=bool),
        np.array([len(t) for t in data], dtype=np.int64),
        np.array([t is None for t in texts], dtype=bool),
        b"".join(data))


def iter_blocks(batches: Iterator[pa.RecordBatch], block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of a stream of ``(id, text binary)`` batches, in row order."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
            t = t.as_py()
            n = 0 if t is None else len(t)
            if ids and (size + n > block_bytes or len(ids) >= BLOCK_ROWS):
                yield _block(ids, texts)
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(t)
            size += n
    if ids:
        yield _block(ids, texts)


def small_batches(spark: SparkSession) -> None:
    """Texts travel to Python workers in batches of at most ``BATCH_ROWS`` rows
    (a session setting; a smaller one is left alone)."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def valid_text(col: str) -> Column:
    """A text as valid UTF-8: bytes that are no character are read as U+FFFD, one for
    each longest start of a character (as Python's ``replace`` does).  Python workers
    cannot read a string with other bytes; operators on bytes need not call it."""
    return F.make_valid_utf8(F.col(col).cast("string"))


def id_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads; whatever else the input has, and
    however it is named, never meets the operator's own columns."""
    small_batches(df.sparkSession)
    return df.select(F.col(id_col).cast("long").alias("_id"),
                     F.col(text_col).cast("binary").alias("_text"))


def n_buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def pack(batches, part_bytes: int = PART_BYTES):
    """Rows ``(id, text, others)`` as blocks, in parts of at most ``part_bytes`` of text."""
    part, comp = TaskContext.get().partitionId() * PARTS_PER_TASK, zstandard.ZstdCompressor(level=3)
    size, last, seq = 0, part + PARTS_PER_TASK - 1, 0
    for batch in batches:
        at = 0
        for b in iter_blocks([batch]):
            if size and size + len(b.data) > part_bytes and part < last:
                part, size = part + 1, 0
            size += len(b.data)
            rest = batch.slice(at, len(b.lens)).select(range(2, batch.num_columns)) if batch.num_columns > 2 else None
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
                "ids": [b.ids.tobytes()], "id_null": [np.packbits(b.id_null).tobytes()],
                "lens": [b.lens.tobytes()], "text_null": [np.packbits(b.text_null).tobytes()],
                "payload": [comp.compress(b.data)], "rest": [None if rest is None else comp.compress(_ipc(rest))]},
                schema=PART_ARROW)
            at, seq = at + len(b.lens), seq + 1
    give_back()


def _ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


PART_ARROW = pa.schema([("part", pa.int32()), ("seq", pa.int32())] + [
    (n, pa.binary()) for n in ("ids", "id_null", "lens", "text_null", "payload", "rest")])


def write_bucketed(df: DataFrame, name: str) -> DataFrame:
    """Write rows bucketed by ``part`` and read them back.

    The table lies in the shared folder, so it survives lost executors.  A task
    writes one file per part it holds, because a part has one bucket.  The
    catalog entry of the (external) table is dropped once the files are bound
    to the returned DataFrame.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    (df.write.bucketBy(n_buckets(spark), "part").format("parquet")
       .option("path", scratch_path(spark, name)).option("compression", "uncompressed")
       .saveAsTable(table))
    out = spark.table(table)
    out.schema  # bound to the files
    spark.sql(f"DROP TABLE {table}")
    return out


def stage_parts(df: DataFrame, id_col: str, text_col: str, name: str, carry: bool = False) -> DataFrame:
    """Write ``(id, text)`` as compressed blocks bucketed by ``part``; with
    ``carry``, the other columns too (see :func:`whole_rows`)."""
    columns = id_text(df, id_col, text_col)
    if carry:  # by place, so that no name can clash
        plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
        spot = df.columns.index(text_col)
        columns = plain.select(F.col(f"c{df.columns.index(id_col)}").cast("long").alias("_id"),
                               F.col(f"c{spot}").cast("binary").alias("_text"),
                               *[F.col(c) for i, c in enumerate(plain.columns) if i != spot])
    return write_bucketed(columns.mapInArrow(pack, PART_SCHEMA), name)


def whole_rows(block: Block, rest: bytes, text_at: int, keep: np.ndarray) -> pa.Table:
    """The kept rows of a block with all their columns, in the input's order."""
    with pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(rest)) as stream:
        table = stream.read_all()
    text = pa.array([None if null else t for t, null in zip(block.texts(), block.text_null)], pa.binary())
    text = text.cast(pa.string(), safe=False)  # the row's own bytes, also where they are not UTF-8
    return table.add_column(text_at, f"c{text_at}", text).filter(pa.array(keep))


def unpack(table: pa.Table) -> Iterator[Block]:
    """Blocks of one part in their original order."""
    for k in block_order(table):
        row = {n: table.column(n)[k].as_py() for n in ("ids", "id_null", "lens", "text_null", "payload")}
        ids = np.frombuffer(row["ids"], np.int64)
        flags = [np.unpackbits(np.frombuffer(row[n], np.uint8), count=len(ids)).astype(bool)
                 for n in ("id_null", "text_null")]
        yield Block(ids, flags[0], np.frombuffer(row["lens"], np.int64), flags[1],
                    zstandard.ZstdDecompressor().decompress(row["payload"]))


def block_order(table: pa.Table) -> list[int]:
    return np.argsort(table.column("seq").to_numpy(), kind="stable").tolist()


def give_back() -> None:
    """Return freed memory to the system.  Python workers are reused, and the
    allocators would keep what the last part or bucket needed."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def squeeze(a: np.ndarray, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(np.ascontiguousarray(a).tobytes())


def expand(b: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype)
