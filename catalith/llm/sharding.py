"""Shards of near-equal bytes: a minimax contiguous partition of groups of equal texts."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalith.llm.common import documents, free_name
from catalith.session import settle

BITS = 60  # of a text's digest, as its place in the order; equal texts have equal places
FIRST_BITS, STEP_BITS = 14, 6


def place(text: Column) -> Column:
    """A text's place in the order of all groups: the first 60 bits of its SHA-256."""
    return F.conv(F.substring(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256), 1, 15), 16, 10).cast("bigint")


class Line:
    """Consecutive items on a line of bytes: single groups, or blocks of several still taken as one."""

    def __init__(self, items: list[tuple[int, int, int, int]]):
        self.items = sorted(items)  # (first place, bits, bytes, groups)
        self.ends = list(accumulate((i[2] for i in self.items), initial=0))
        self.total = self.ends[-1]
        self.largest = max((i[2] for i in self.items if i[3] == 1), default=0)

    def reach(self, start: int, capacity: int) -> int:
        """The last item end that a shard from ``start`` with this capacity can have."""
        return self.ends[bisect_right(self.ends, start + capacity) - 1]

    def cuts(self, capacity: int, shards: int, whole: bool) -> list[int]:
        """Ends of greedily filled shards; ``whole`` keeps blocks whole, else they part anywhere."""
        out, at = [], 0
        for _ in range(shards):
            at = self.reach(at, capacity) if whole else min(at + capacity, self.total)
            out.append(at)
        return out

    def smallest(self, shards: int, whole: bool) -> int:
        """The smallest capacity with which ``shards`` greedily filled shards hold everything."""
        low = max(self.largest, -(-self.total // shards), *( [i[2] for i in self.items] if whole else [0]))
        high = max(low, self.total)
        while low < high:
            middle = (low + high) // 2
            if self.cuts(middle, shards, whole)[-1] == self.total:
                high = middle
            else:
                low = middle + 1
        return low

    def undecided(self, shards: int, low: int, high: int) -> list[tuple[int, int]]:
        """Blocks in which a cut may fall for some capacity between the two, as item numbers."""
        spans = list(zip(self.cuts(low, shards, True), self.cuts(high, shards, False)))
        backward, at_low, at_high = [], self.total, self.total
        for _ in range(shards):  # the same from the far end
            at_low = self.ends[bisect_left(self.ends, max(at_low - low, 0))]
            at_high = max(at_high - high, 0)
            backward.append((at_high, at_low))
        fair = [self.total * k // shards for k in range(1, shards)]
        out = []
        for first, last in [*spans, *backward, *((f, f) for f in fair)]:
            a = max(bisect_right(self.ends, first) - 1, 0)
            b = min(bisect_left(self.ends, last), len(self.items))
            out += [i for i in range(a, b) if self.items[i][3] > 1]
        return sorted(set(out))

    def balanced(self, capacity: int, shards: int) -> list[int]:
        """Cuts of at most ``capacity`` each, as close to equal shares as that allows."""
        earliest, at = [self.total], self.total
        for _ in range(shards - 1):
            at = self.ends[bisect_left(self.ends, max(at - capacity, 0))]
            earliest.append(at)
        earliest.reverse()  # earliest[k]: where shard k must end at the earliest
        out, start = [], 0
        for k in range(shards - 1):
            last, first = self.reach(start, capacity), earliest[k]
            fair = start + (self.total - start) // (shards - k)
            at = bisect_left(self.ends, fair)
            near = min(self.ends[max(at - 1, 0): at + 1], key=lambda e: abs(e - fair))
            start = min(max(near, first, start), max(last, start))
            out.append(start)
        return [*out, self.total]


def find_cuts(groups: DataFrame, shards: int) -> list[int]:
    """First places of shards 1, 2, ... for groups (place, bytes), exact although few rows reach the driver.

    The binary search runs over blocks: all groups that share their first bits.  With blocks kept whole
    it gives a capacity that suffices, with blocks parted anywhere one that is needed.  Only blocks in
    which a cut may fall in between are read again, in smaller blocks, until the cuts are exact.  The
    driver holds 2**14 blocks and 64 more for each block read again.
    """
    def blocks(df: DataFrame, bits: int) -> list[tuple[int, int, int, int]]:
        first = F.shiftleft(F.shiftright("place", BITS - bits), BITS - bits)
        rows = df.groupBy(first.alias("first")).agg(
            F.sum("bytes").alias("bytes"), F.count("*").alias("groups"), F.min("place").alias("low")).collect()
        return [(r.low if r.groups == 1 else r.first, BITS if r.groups == 1 else bits, r.bytes, r.groups) for r in rows]

    line = Line(blocks(groups, FIRST_BITS))
    if not line.items:
        return []
    while True:
        low, high = line.smallest(shards, False), line.smallest(shards, True)
        again = line.undecided(shards, low, high)
        if not again:
            break
        chosen = [line.items[i] for i in again]
        kept = [item for i, item in enumerate(line.items) if i not in set(again)]
        for bits in sorted({c[1] for c in chosen}):
            span = BITS - bits
            ids = [c[0] >> span for c in chosen if c[1] == bits]
            wanted = groups.where(F.shiftright("place", span).isin(ids))
            kept += blocks(wanted, min(bits + STEP_BITS, BITS))
        line = Line(kept)
    cuts = line.balanced(high, shards)
    starts = [line.items[bisect_left(line.ends, c)][0] if c < line.total else 1 << BITS for c in cuts[:-1]]
    return starts


def shard(
    docs: DataFrame, shards: int = 40, overhead: int = 16, id_col: str = "doc_id", text_col: str = "text",
    slot_rows: int = 1_000_000,
) -> DataFrame:
    """Documents in ``shards`` shards of near-equal size, equal texts together.

    Adds (with underscores in front where ``docs`` has such columns) shard, slot, size and text_crc32.
    Size is the text's UTF-8 bytes plus ``overhead``.  Groups of equal texts stand in the order of a
    digest.  A group larger than a fair share of what is left fills a shard of its own (there are
    fewer of these than shards); over the others the smallest feasible capacity is searched and the
    order cut there (``find_cuts``).  With no group that large, no other contiguous cutting has a
    smaller largest shard.

    Slots count from 0 without gaps in each shard: counts per hash bucket of ids give each bucket its
    first slot, and rows are numbered inside their bucket, so no shard meets in one task.  Missing
    texts are empty, equal or missing ids are allowed (equal rows are interchangeable), an empty table
    gives no rows.
    """
    names = {n: free_name(docs, n) for n in ("size", "text_crc32", "place", "shard", "bucket", "slot", "base")}
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        "*", (F.octet_length(text).cast("bigint") + overhead).alias(names["size"]),
        F.crc32(text.cast("binary")).alias(names["text_crc32"]), place(text).alias(names["place"]))
    groups = settle(
        rows.groupBy(F.col(names["place"]).alias("place")).agg(
            F.sum(names["size"]).alias("bytes"), F.count("*").alias("n")), "shard-groups")
    left, n_rows = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    alone: list[int] = []
    for r in groups.orderBy(F.desc("bytes"), "place").limit(shards).collect():
        if len(alone) < shards - 1 and r.bytes * (shards - len(alone)) > left:
            alone.append(r.place)
            left -= r.bytes
        else:
            break
    rest = groups.where(~F.col("place").isin(alone)) if alone else groups
    starts = find_cuts(rest, shards - len(alone))

    at = F.col(names["place"])
    number = F.lit(len(alone))
    for start in starts:
        number = number + (at >= start).cast("int")
    for k, own in reversed(list(enumerate(alone))):
        number = F.when(at == own, F.lit(k)).otherwise(number)
    spread = max(256, n_rows // slot_rows)
    s, b, base = names["shard"], names["bucket"], names["base"]
    rows = rows.withColumn(s, number).withColumn(b, F.pmod(F.xxhash64(id_col), F.lit(spread)).cast("int"))
    # counted on the few columns it needs; at most shards * spread rows
    counts = settle(rows.groupBy(s, b).count(), "shard-buckets")
    before = Window.partitionBy(s).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(s, b, F.coalesce(F.sum("count").over(before), F.lit(0)).alias(base))
    inside = Window.partitionBy(s, b).orderBy(id_col, names["place"], names["size"])
    return (
        rows.join(bases, [s, b]).withColumn(names["slot"], F.col(base) + F.row_number().over(inside) - 1)
        .select(*[f"`{c}`" for c in docs.columns], names["size"], names["text_crc32"], s, names["slot"]))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near-equal bytes."""
    placed = shard(documents(spark, sf_dir, "doc_id", "text"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
