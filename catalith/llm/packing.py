"""Packing of token sequences into windows of a fixed size with a bounded number of open windows."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalith.llm.common import documents
from catalith.llm.tokens import word_ids
from catalith.session import settle

PLACED = (
    "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
    "part int, window bigint, offset bigint, closed boolean"
)
NAMES = ["doc_id", "start", "length", "ids", "doc_tokens"]
ARROW_PLACED = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
    ("doc_tokens", pa.int64()), ("part", pa.int32()), ("window", pa.int64()), ("offset", pa.int64()),
    ("closed", pa.bool_()),
])


class OpenWindows:
    """At most ``most`` windows that still take pieces, kept in order of free space."""

    def __init__(self, size: int, most: int):
        self.size, self.most, self.made = size, most, 0
        self.free: list[tuple[int, int]] = []  # (free tokens, window)
        self.held: dict[int, list[tuple]] = {}
        self.out: list[tuple] = []

    def _close(self, window: int, closed: bool = True) -> None:
        self.out += [(*piece, window, at, closed) for piece, at in self.held.pop(window)]

    def place(self, piece: tuple, length: int) -> None:
        """Put a piece where the least room is left over; close the fullest window if none has room."""
        at = bisect_left(self.free, (length, -1))
        if at < len(self.free):
            free, window = self.free.pop(at)
        else:
            if len(self.free) >= self.most:
                self._close(self.free.pop(0)[1])
            free, window = self.size, self.made
            self.made += 1
            self.held[window] = []
        self.held[window].append((piece, self.size - free))
        if free == length:
            self._close(window)
        else:
            insort(self.free, (free - length, window))

    def leave(self) -> None:
        """Hand on what is still open."""
        for _, window in self.free:
            self._close(window, closed=False)
        self.free = []

    def take(self) -> list[tuple]:
        out, self.out = self.out, []
        return out


def _placer(vocabulary: str, end_id: int, size: int, open_windows: int, remember: int):
    end = np.array([end_id], "<u4").tobytes()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, windows = word_ids(vocabulary, remember), OpenWindows(size, open_windows)
        part = TaskContext.get().partitionId()

        def rows() -> pa.RecordBatch:
            columns = list(zip(*windows.take())) or [()] * 8
            columns.insert(5, [part] * len(columns[0]))
            arrays = [pa.array(c, f.type) for c, f in zip(columns, ARROW_PLACED)]
            return pa.RecordBatch.from_arrays(arrays, schema=ARROW_PLACED)

        for batch in batches:
            for block in (batch.slice(at, 500) for at in range(0, batch.num_rows, 500)):
                for key, ids in zip(block.column(0).to_pylist(), encoder.encode(block.column(1).to_pylist())):
                    ids += end
                    total = len(ids) // 4
                    for start in range(0, total, size):
                        piece = ids[4 * start: 4 * (start + size)]
                        length = len(piece) // 4
                        windows.place((key, start, length, piece, total), length)
                yield rows()
        windows.leave()
        yield rows()

    return place


def _merged(left: DataFrame, size: int, merge_parts: int) -> DataFrame:
    """The pieces of open windows laid end to end, per ``merge_parts`` partitions, and cut at every window's end.

    Only lengths decide where a piece lies, so the ids stay in Spark's rows.
    """
    before = Window.partitionBy("group").orderBy("part", "window", "offset").rowsBetween(Window.unboundedPreceding, -1)
    laid = (
        left.withColumn("group", F.floor(F.col("part") / merge_parts).cast("bigint"))
        .withColumn("filled", F.coalesce(F.sum("length").over(before), F.lit(0)))
        .withColumn("k", F.explode(F.expr(f"sequence(filled div {size}, (filled + length - 1) div {size})")))
        .withColumn("from", F.greatest(F.col("filled"), F.col("k") * size))
        .withColumn("step", F.least(F.col("filled") + F.col("length"), (F.col("k") + 1) * size) - F.col("from"))
        .withColumn("done", F.col("from") - F.col("filled")))
    return laid.select(
        "doc_id", (F.col("start") + F.col("done")).alias("start"), F.col("step").alias("length"),
        F.expr("substring(ids, cast(4 * done + 1 as int), cast(4 * step as int))").alias("ids"), "doc_tokens",
        (F.shiftleft(2 * F.col("group") + 1, 32) + F.col("k")).alias("sequence_id"),
        (F.col("from") - F.col("k") * size).alias("offset"))


def pack(
    docs: DataFrame, vocabulary: str = "word_bpe_49k.json", end_id: int = 2, size: int = 4096,
    open_windows: int = 128, merge_parts: int = 16, id_col: str = "doc_id", text_col: str = "text",
    remember: int = 1_600_000,
) -> DataFrame:
    """Pieces of all documents, placed into sequences of at most ``size`` ids.

    Every partition keeps ``open_windows`` windows.  A document's ids (with ``end_id`` behind them)
    are cut at multiples of ``size``; each piece goes where it leaves the least room, and where none
    has room the fullest window is closed.  The windows that stay open in ``merge_parts`` partitions
    are laid end to end and cut at window ends, so that one window per such group is not full.
    Memory of a Python worker: the open windows of one partition, the pieces of 500 texts and the ids of
    ``remember`` words; none grows with the input.  Open windows are merged by Spark, in a window that sorts
    those of ``merge_parts`` partitions.  The placed pieces are written to the shared folder once, so texts are encoded once.

    Gives doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.
    A missing or empty text has the end id alone.  Repeated rows are documents of their own, a
    missing id stays missing, an empty table gives no rows, other columns are not read.
    """
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    placed = settle(
        slim.mapInArrow(_placer(vocabulary, end_id, size, open_windows, remember), PLACED), "packed-pieces")
    closed = placed.where("closed").select(
        *NAMES, (F.shiftleft(F.col("part").cast("bigint") * 2, 32) + F.col("window")).alias("sequence_id"),
        "offset")
    return closed.unionByName(_merged(placed.where("not closed"), size, merge_parts))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 ids, one row per piece."""
    pieces = pack(documents(spark, sf_dir, "doc_id", "text"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
