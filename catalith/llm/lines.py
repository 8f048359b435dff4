"""Removal of repeated lines by a sharded minimal perfect hash over line hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.functions.text import let
from catalith.llm.common import documents, free_name
from catalith.session import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_ID = 2**63 - 1
INDEX = "shard int, bits binary, sizes array<bigint>, prints binary, docs binary, counts binary, salts int"


def line_key(line: Column) -> Column:
    """The line without ASCII blanks at its ends, ASCII letters in lower case."""
    return F.translate(F.btrim(line, F.lit(" \t\n\x0b\x0c\r")), UPPER, LOWER)


def split_lines(text: Column) -> Column:
    """All lines of a text; a missing or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


# ---- the perfect hash, on arrays of one shard ----

def _place(hashes: np.ndarray, marks: np.ndarray, level: int, size: int) -> np.ndarray:
    x = (hashes + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)) ^ (marks >> np.uint64(7))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(29))) % np.uint64(size)).astype(np.int64)


def build(hashes: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, list[int], np.ndarray]:
    """Bits of all levels, the levels' sizes, and the slot of each key.

    Keys alone at their place in a level are settled there; the others go on to the next level.
    A key's slot is the number of bits set before its own, so slots are 0 to n - 1.
    """
    rest, bits, sizes, spots, base = np.arange(len(hashes)), [], [], np.zeros(len(hashes), np.int64), 0
    while len(rest):
        size = max(64, 2 * len(rest))
        at = _place(hashes[rest], marks[rest], len(sizes), size)
        alone = np.bincount(at, minlength=size)[at] == 1
        level = np.zeros(size, bool)
        level[at[alone]] = True
        spots[rest[alone]] = base + at[alone]
        bits.append(level)
        sizes.append(size)
        base += size
        rest = rest[~alone]
    bits = np.concatenate(bits) if bits else np.zeros(0, bool)
    return bits, sizes, (np.cumsum(bits) - 1)[spots] if len(hashes) else spots


def probe(bits: np.ndarray, sizes: list[int], hashes: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """The slot each key would have, or -1; keys outside the set may get any slot."""
    ranks, slots = np.cumsum(bits) - 1, np.full(len(hashes), -1, np.int64)
    rest, base = np.arange(len(hashes)), 0
    for level, size in enumerate(sizes):
        at = base + _place(hashes[rest], marks[rest], level, size)
        hit = bits[at]
        slots[rest[hit]] = ranks[at[hit]]
        rest, base = rest[~hit], base + size
    return slots


def _unsigned(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().astype(np.int64).view(np.uint64)


def _build_shard(mean: float):
    def shard(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        hashes, marks = _unsigned(table.column("hash")), _unsigned(table.column("mark"))
        bits, sizes, slots = build(hashes, marks)
        prints, docs, counts = np.zeros(len(slots), "<u8"), np.zeros(len(slots), "<i8"), np.zeros(len(slots), "u1")
        prints[slots] = marks
        docs[slots] = table.column("first_doc").to_numpy()
        found = table.column("n").to_numpy()
        counts[slots] = table.column("docs").to_numpy()
        return pa.table({
            "shard": pa.array([key[0].as_py()], pa.int32()), "bits": [np.packbits(bits).tobytes()],
            "sizes": pa.array([sizes], pa.list_(pa.int64())), "prints": [prints.tobytes()],
            "docs": [docs.tobytes()], "counts": [counts.tobytes()],
            # copies of the shard: until its hottest line is no more than an average shard; together they
            # hold no more rows than that line has
            "salts": pa.array([int(1 + found.max() // mean)], pa.int32()),
        })

    return shard


PROBED = pa.schema([("doc", pa.int64()), ("row", pa.int64()), ("place", pa.int32())])


def _probe_shard(lines: pa.Table, index: pa.Table) -> pa.Table:
    """The lines, by document and place, that several documents hold and an earlier one than this."""
    if not lines.num_rows or not index.num_rows:
        return PROBED.empty_table()
    shard = index.slice(0, 1).to_pylist()[0]
    sizes = shard["sizes"]
    bits = np.unpackbits(np.frombuffer(shard["bits"], np.uint8), count=sum(sizes)).astype(bool)
    hashes, marks = _unsigned(lines.column("hash")), _unsigned(lines.column("mark"))
    slots = probe(bits, sizes, hashes, marks)
    known = slots >= 0
    known &= np.frombuffer(shard["prints"], "<u8")[slots] == marks
    known &= np.frombuffer(shard["counts"], "u1")[slots] >= 2
    known &= np.frombuffer(shard["docs"], "<i8")[slots] != lines.column("doc").to_numpy()
    return lines.select(["doc", "row", "place"]).filter(pa.array(known)).cast(PROBED)


def without(lines: Column, places: Column) -> Column:
    """The lines at other than the given places (distinct, from 0), in order.

    Places and lines are sorted together, a place in front of the line it names; so the work grows with n log n
    of the lines, however many places there are.
    """
    def kept(both: Column) -> Column:
        def stays(x: Column, i: Column) -> Column:
            before = F.get(both, i - 1)
            return x["named"] & ~F.coalesce((before["place"] == x["place"]) & ~before["named"], F.lit(False))

        return F.transform(F.filter(both, stays), lambda x: x["line"])

    marks = F.transform(places, lambda p: F.struct(
        p.cast("int").alias("place"), F.lit(False).alias("named"), F.lit(None).cast("string").alias("line")))
    all_lines = F.transform(lines, lambda line, i: F.struct(i.alias("place"), F.lit(True).alias("named"), line.alias("line")))
    return let(F.sort_array(F.concat(marks, all_lines)), kept)


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_points: int = 10,
    shard_rows: int = 100_000,
) -> DataFrame:
    """The documents with the lines dropped that an earlier document holds.

    A line's key is given by ``line_key``.  Keys of at least ``min_points`` code points found in at
    least two documents stay in the smallest id that holds them (there all of their lines stay).
    The result has the input's columns, ``text_col`` being what is left, and n_lines and n_dropped
    (with underscores in front if the input has such columns).

    All distinct line hashes are indexed per shard by a minimal perfect hash into arrays of
    fingerprints, first documents and counts (1, or 2 for more documents), and the arrays decide.  A line outside the
    set may lead to any slot, so a fingerprint is a second hash of 64 bits: of 10^12 lines one is mistaken with a
    chance of 1 in 10^7.  Documents send hashes and places of their lines, never lines, to the shard.  The number of
    shards grows with the lines, so none holds more than about ``shard_rows`` keys; pairs of a shard with a hot line
    are dealt over copies of it.  Only the number of lines reaches the driver.

    The places to drop come back to the document and are taken out in one merge, so a text of a million repeated
    lines takes seconds.  Rows that share an id count as one document; a missing id counts as the
    largest.  Missing and empty texts are one empty line and become the empty text.  Very long texts are whole
    texts like others.  An empty table stays empty.
    """
    n_lines, n_dropped = free_name(docs, "n_lines"), free_name(docs, "n_dropped")
    doc = F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID))
    row = F.xxhash64(F.col(text_col), F.lit(11))  # rows that share an id have places of their own
    pairs = settle(
        # the text is hashed before it is parted, not once for each line
        docs.select(doc.alias("doc"), row.alias("row"), split_lines(F.col(text_col)).alias("lines"))
        .select("doc", "row", F.posexplode("lines").alias("place", "line"))
        .select("doc", "row", "place", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_points)
        .select("doc", "row", "place", F.xxhash64("key").alias("hash"), F.xxhash64(F.lit(7), "key").alias("mark")),
        "line-hashes")
    shards = int(max(16, (total := pairs.count()) // shard_rows))
    shard = F.pmod(F.col("hash"), F.lit(shards)).cast("int")
    index = settle(
        pairs.groupBy("hash", "mark").agg(
            F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc"), F.count("*").alias("n"))
        .withColumn("docs", F.when(F.col("first_doc") < F.col("last_doc"), 2).otherwise(1))
        .withColumn("shard", shard).groupBy("shard")
        .applyInArrow(_build_shard(max(1.0, total / shards)), INDEX), "line-index")
    hot = settle(index.where("salts > 1").select("shard", "salts"), "hot-shards")
    sent = (
        pairs.withColumn("shard", shard).join(hot, "shard", "left")
        .withColumn("salt", F.pmod(F.xxhash64("doc", "place"), F.coalesce("salts", F.lit(1)).cast("bigint")).cast("int"))
        .drop("salts"))
    copies = index.withColumn("salt", F.explode(F.expr("sequence(0, salts - 1)")))
    dropped = (
        sent.groupBy("shard", "salt").cogroup(copies.groupBy("shard", "salt"))
        .applyInArrow(_probe_shard, "doc bigint, row bigint, place int")
        .groupBy("doc", "row").agg(F.collect_set("place").alias("gone")))

    key, row_key, gone, lines, left = (free_name(docs, n) for n in ("doc_key", "row_key", "gone", "lines", "left"))
    joined = docs.withColumns({key: doc, row_key: row}).join(
        dropped.select(F.col("doc").alias(key), F.col("row").alias(row_key), F.col("gone").alias(gone)), [key, row_key], "left")
    parted = joined.withColumn(lines, split_lines(F.col(text_col))).withColumn(
        left, F.when(F.col(gone).isNull(), F.col(lines)).otherwise(without(F.col(lines), F.col(gone))))
    columns = [
        F.array_join(left, "\n").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    return parted.select(
        *columns, F.size(lines).cast("bigint").alias(n_lines),
        (F.size(lines) - F.size(left)).cast("bigint").alias(n_dropped))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What line dedup leaves of every document, as digests."""
    left = dedup_lines(documents(spark, sf_dir, "doc_id", "text"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


SQL = """
WITH lines AS (
  SELECT row_id, doc_id, i, line,
    translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (
    SELECT row_id, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS i
    FROM (
      SELECT row_number() OVER () AS row_id, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts
      FROM documents))
), firsts AS (
  SELECT key, min(coalesce(doc_id, 9223372036854775807)) AS first_doc
  FROM lines WHERE length(key) >= 10 GROUP BY key
  HAVING min(coalesce(doc_id, 9223372036854775807)) < max(coalesce(doc_id, 9223372036854775807))
), judged AS (
  SELECT l.*, f.first_doc IS NOT NULL AND f.first_doc <> coalesce(l.doc_id, 9223372036854775807) AS gone
  FROM lines l LEFT JOIN firsts f USING (key)
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY row_id
"""
