"""Exact join of texts by the Jaccard similarity of their word shingles, by PartEnum signatures."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalith.llm.common import digest, documents
from catalith.llm.neardup import _mixed, components, shingles
from catalith.llm.quality import MIX
from catalith.session import release, settle

# Similarity 4/5: sizes a <= b link only if 4 b <= 5 a, and then differ in at most (a + b) / 9 elements.
PROBE = 3  # tenths of the feature domain whose elements are counted over the corpus
FEW = 8  # members up to which a mixed bucket's pairs are listed
HUBS = 8  # members of a large bucket's largest class that its other members are compared with first
SIEVE_BITS = 26  # a sieve has at most 2 ** 26 places, 8 MB

SKETCH = pa.schema([
    ("id", pa.int64()), ("copy", pa.binary()), ("same", pa.binary()), ("n", pa.int64()), ("probe", pa.list_(pa.int64()))])
SKETCH_DDL = "id bigint, copy binary, same binary, n bigint, probe array<bigint>"
WHOLE = pa.schema([("node", pa.int64()), ("elements", pa.list_(pa.int64()))])
WHOLE_DDL = "node bigint, elements array<bigint>"
SIGNED = pa.schema([
    ("node", pa.int64()), ("n", pa.int64()), ("odd", pa.binary()), ("elements", pa.binary()), ("signs", pa.list_(pa.int64()))])
SIGNED_DDL = "node bigint, n bigint, odd binary, elements binary, signs array<bigint>"


class Scheme(NamedTuple):
    """How PartEnum cuts the domain so that sets that differ in at most ``k`` elements share a signature."""

    k: int
    first: int  # parts of the domain
    second: int  # parts of each part
    free: int  # second parts left out of a signature
    spare: int  # parts beyond those that ``k`` differences can spoil


@lru_cache(maxsize=None)
def band(n: int) -> tuple[int, int]:
    """Number and largest size of the size band that holds ``n``; the bands' ends stand in the ratio 4 to 5."""
    low = number = 1
    while (high := 5 * low // 4) < n:
        low, number = high + 1, number + 1
    return number, high


@lru_cache(maxsize=None)
def scheme(high: int) -> Scheme:
    """The scheme for pairs of which neither is larger than ``high``.

    Few differences: one part, cut so that any ``k`` second parts may be left out.  Else so many parts
    that, as two differences spoil a part, at least ``1 + spare`` parts have at most one; each of those is cut in
    three, one of which is left out.
    """
    k = 2 * high // 9
    if k <= 3:
        return Scheme(k, 1, k + 3, k, 0)
    spare = 1 + (k // 2 + 1) // 8
    return Scheme(k, k // 2 + 1 + spare, 3, 1, spare)


def signatures(sets: list[np.ndarray], high: int, number: int, least: int = 2) -> list[np.ndarray]:
    """Signatures of sets of 64-bit hashes under the scheme of band ``number``, whose largest size is ``high``.

    A signature hashes a set's elements in the chosen second parts of one part.  Signatures of fewer than
    ``least`` elements say little and are left out wherever that loses nothing: of the parts that a similar
    pair leaves intact at least ``1 + spare`` exist, so a set with at most ``spare`` parts that lead to such a
    signature shares a fuller one with every similar set.  Sets with more such parts keep all.
    """
    s = scheme(high)
    if s.k == 0 or not sets:
        return [np.empty(0, np.uint64)] * len(sets)
    cells = s.first * s.second
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    elements = np.concatenate(sets)
    at = owner * cells + (_mixed(elements ^ np.uint64(number * 0x632BE59BD9B4E019 % 2**64)) % np.uint64(cells)).astype(np.int64)
    sums = np.zeros(len(sets) * cells, np.uint64)
    np.add.at(sums, at, _mixed(elements * MIX))
    held = np.bincount(at, minlength=len(sums)).reshape(-1, s.first, s.second)
    sums = sums.reshape(-1, s.first, s.second)
    kept = list(combinations(range(s.second), s.second - s.free))
    values = np.stack([sums[:, :, list(c)].sum(axis=2, dtype=np.uint64) for c in kept], axis=2)
    full = np.stack([held[:, :, list(c)].sum(axis=2) for c in kept], axis=2) >= least
    names = np.arange(1, s.first * len(kept) + 1, dtype=np.uint64).reshape(s.first, -1) + np.uint64(number << 32)
    values = _mixed(values * MIX ^ _mixed(names))
    poor = (~full).any(axis=2).sum(axis=1) > s.spare
    full[poor] = True
    return [v[f] for v, f in zip(values, full)]


def odd_bits(elements: np.ndarray) -> bytes:
    """One bit for each of at least two places per element: whether an odd number of elements falls there.

    Each element in which two sets differ changes one bit, so sets never differ in fewer elements than bits.
    Halves laid over each other give the bits for half as many places.
    """
    places = 1 << max(6, (2 * len(elements) - 1).bit_length())
    at = (_mixed(elements + MIX) % np.uint64(places)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=places).astype(np.uint8) & 1).tobytes()


def differing_bits(a: bytes, b: bytes) -> int:
    """Bits in which two sets differ, on as many places as the smaller one has."""
    x, y = (np.frombuffer(v, np.uint8) for v in (a, b))
    while len(x) != len(y):
        if len(x) > len(y):
            x, y = y, x
        y = y[: len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def _sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each text; bytes are lower-cased, which touches A to Z alone."""
    return [np.unique(shingles(t.lower(), width)) for t in texts.cast(pa.binary()).to_pylist()]


def _sketcher(width: int):
    limit = np.uint64(2**64 // 10 * PROBE)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(at, 2000) for at in range(0, batch.num_rows, 2000)):
                sets = _sets(part.column(2), width)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1).cast(pa.binary()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s[: np.searchsorted(s, limit)].view(np.int64) for s in sets], pa.list_(pa.int64())),
                ], schema=SKETCH)

    return sketch


def _lister(width: int):
    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(at, 2000) for at in range(0, batch.num_rows, 2000)):
                sets = [s.view(np.int64) for s in _sets(part.column(1), width)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.list_(pa.int64()))], schema=WHOLE)

    return lists


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in (batch.slice(at, 500) for at in range(0, batch.num_rows, 500)):
            ends = np.cumsum(pc.list_value_length(part.column(1)).to_numpy(zero_copy_only=False))
            sets = np.split(part.column(1).flatten().to_numpy().view(np.uint64), ends[:-1])
            signs: list[list[np.ndarray]] = [[] for _ in sets]
            bands: dict[tuple[int, int], list[int]] = {}
            for i, s in enumerate(sets):
                number, high = band(len(s))
                bands.setdefault((number, high), []).append(i)
                bands.setdefault((number + 1, 5 * (high + 1) // 4), []).append(i)  # with larger partners
            for (number, high), rows in bands.items():
                for i, found in zip(rows, signatures([sets[i] for i in rows], high, number)):
                    signs[i].append(found)
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([odd_bits(s) for s in sets], pa.binary()),
                pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary()),
                pa.array([np.concatenate(s).view(np.int64) for s in signs], pa.list_(pa.int64())),
            ], schema=SIGNED)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep, last, left = [], None, None
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            if x is not last:
                last, left = x, np.frombuffer(x, "<u8")
            right = np.frombuffer(y, "<u8")
            common = len(np.intersect1d(left, right, assume_unique=True))
            keep.append(5 * common >= 4 * (len(left) + len(right) - common))
        keep = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose bits differ in no more places than a linked pair's elements may."""
    for batch in batches:
        columns = (batch.column(i).to_pylist() for i in (2, 3, 4))
        keep = pa.array([9 * differing_bits(x, y) <= n for n, x, y in zip(*columns)], pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])


def _fits(a: str, b: str) -> Column:
    return 4 * F.greatest(a, b) <= 5 * F.least(a, b)


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that reach the similarity: first by sizes and bits, then by their whole sets."""
    def of(name: str, column: str) -> DataFrame:
        return sets.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"), F.col(column).alias(f"set_{name}"))

    once = pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    near = settle(
        once.join(of("a", "odd"), "a").join(of("b", "odd"), "b").where(_fits("n_a", "n_b"))
        .select("a", "b", (F.col("n_a") + F.col("n_b")).alias("n"), "set_a", "set_b")
        .mapInArrow(_near, "a bigint, b bigint"), "near-pairs")
    links = settle(
        near.join(of("a", "elements"), "a").join(of("b", "elements"), "b").select("a", "b", "set_a", "set_b")
        .mapInArrow(_verify, "a bigint, b bigint"), "jaccard-links")
    release(near)
    return links


def _may_pair(members: DataFrame, nodes: DataFrame, purpose: str) -> DataFrame:
    """The nodes of which so few of the elements in ``members`` are in no other set that they can have a partner.

    A set of n elements has at most n - ceil(4 n / 5) that its partner lacks, so a set with more elements
    that no other set holds has no partner at all.  That is exact for any part of the elements,
    and takes texts that only share passages out of the join.
    """
    alone = (
        members.groupBy("element").agg(F.count("*").alias("sets"), F.min("node").alias("node")).where("sets = 1")
        .groupBy("node").agg(F.count("*").alias("alone")))
    allowed = F.col("n") - F.ceil(F.col("n") * 4 / 5)
    return settle(
        nodes.join(alone, "node", "left").where(F.coalesce("alone", F.lit(0)) <= allowed).select("node", "n", "id", "copy"),
        purpose)


def _candidates(sketches: DataFrame, nodes: DataFrame) -> DataFrame:
    """The nodes that can have a partner, by the elements in a fixed part of the domain, counted over all sets."""
    probes = sketches.join(nodes.drop("n"), ["same", "id", "copy"]).select("node", F.explode("probe").alias("element"))
    return _may_pair(probes, nodes, "join-candidates")


def _sieve(rows: DataFrame, keys: list[str], wanted: DataFrame) -> DataFrame:
    """The rows whose keys may be among those of ``wanted``: none of these is lost, and few others stay.

    Every wanted key marks its place in a bitmap that all tasks get, so nothing is shuffled for rows that
    are not wanted.  There are at least 16 places per key until the bitmap has its full 8 MB; with
    more keys more rows stay, which costs the reader's own exact join time but no result.
    """
    places = 1 << min(SIEVE_BITS, max(15, (16 * wanted.count()).bit_length()))
    place = F.pmod(F.xxhash64(*keys), F.lit(places))
    marks = settle(
        wanted.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("_bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("_bits")), "sieve")
    bit = F.bitmap_bit_position("_place")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.expr("shiftright(_byte, cast(_bit % 8 as int)) & 1 = 1")
    return (
        rows.withColumn("_place", place).withColumn("_bucket", F.bitmap_bucket_number("_place"))
        .join(F.broadcast(marks), "_bucket").withColumn("_byte", byte).withColumn("_bit", bit).where(marked)
        .select(*rows.columns))


def _mixed_members(members: DataFrame, roots: DataFrame) -> DataFrame:
    """(sign, node, root, size) of the buckets whose members are in several classes so far."""
    known = settle(members.join(roots, "node", "left").select(
        "sign", "node", F.coalesce("root", "node").alias("root")), "bucket-classes")
    # written before they are joined, because a join with an aggregate in its own stage cannot be split
    several = settle(
        known.groupBy("sign").agg(F.count("*").alias("size"), F.min("root").alias("least"), F.max("root").alias("most"))
        .where("least < most").select("sign", "size"), "mixed-buckets")
    return settle(known.join(several, "sign"), "mixed-members")


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = [np.frombuffer(x, "<u8").view(np.int64) for x in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(lists, pa.list_(pa.int64()))], names=["node", "root", "elements"])


def _shared(flat: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, root, n, element, sets) of the elements that several sets hold, and the nodes with enough of them.

    A partner holds at least 4/5 of a set's elements, so a set of which fewer stand in any other set has none.
    """
    often = settle(flat.groupBy("element").agg(F.count("*").alias("sets")).where("sets > 1"), "shared-elements")
    held = settle(flat.join(often, "element"), "held-elements")
    release(often)
    enough = settle(
        held.groupBy("node", "n").agg(F.count("*").alias("shared")).where(F.col("shared") >= F.ceil(F.col("n") * 4 / 5))
        .select("node", "shared"), "held-counts")
    return held, enough


def _rest(open_nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """All pairs of open nodes of different classes that can link, for buckets too large to list.

    Over the open nodes alone the elements are counted in full, and once more over the nodes that have enough
    shared ones.  What a set may lack in its partner are n - ceil(4 n / 5) elements at most, so of two similar sets,
    ordered by how many sets hold an element, some element is within the first n - ceil(4 n / 5) + 1 of
    both.  Elements of one set fill these places first, so texts that share passages hardly meet.  In an
    element's list the members outside its largest class meet the others, where enough of both sets is left.
    """
    lists = open_nodes.join(sets, "node").select("node", "root", "elements").mapInArrow(
        _unpack, "node bigint, root bigint, elements array<bigint>")
    flat = settle(lists.select("node", "root", F.size("elements").alias("n"), F.explode("elements").alias("element")), "open-elements")
    held, enough = _shared(flat)
    again, enough = _shared(held.drop("sets").join(enough.select("node"), "node"))
    release(flat, held)
    place = F.row_number().over(Window.partitionBy("node").orderBy("sets", "element"))
    lead = settle(
        again.withColumn("place", place).join(enough, "node").withColumn("at", F.col("place") + F.col("n") - F.col("shared"))
        .where(F.col("at") <= F.col("n") - F.ceil(F.col("n") * 4 / 5) + 1)
        .select("element", "node", "root", "n", "at"), "leading-elements")
    release(again)
    largest = settle(
        lead.groupBy("element", "root").count().groupBy("element")
        .agg(F.count("*").alias("classes"), F.max(F.struct("count", "root"))["root"].alias("largest"))
        .where("classes > 1").select("element", "largest"), "mixed-elements")
    mixed = settle(lead.join(largest, "element"), "mixed-lists")
    other = mixed.select("element", *[F.col(c).alias(f"{c}_b") for c in ("node", "root", "n", "at")])
    # at their first common element, two linked sets still have 4/9 of both sizes in common from there on
    enough_left = 9 * (F.least(F.col("n") - F.col("at"), F.col("n_b") - F.col("at_b")) + 1) >= 4 * (F.col("n") + F.col("n_b"))
    return mixed.where("root <> largest").join(other, "element").where(
        (F.col("root") != F.col("root_b")) & _fits("n", "n_b") & enough_left).select(
        F.col("node").alias("a"), F.col("node_b").alias("b"))


def _outsiders(mixed: DataFrame, hubs: int) -> DataFrame:
    """Pairs of each member outside its bucket's largest class with ``hubs`` members of that class, chosen by hash."""
    largest = settle(
        mixed.groupBy("sign", "root").count().groupBy("sign").agg(F.max(F.struct("count", "root"))["root"].alias("largest")),
        "largest-classes")
    known = settle(mixed.join(largest, "sign"), "bucket-sides")
    chosen = known.where("root = largest").groupBy("sign").agg(*[
        F.min(F.struct(F.xxhash64("node", F.lit(k)), "node"))["node"].alias(f"hub{k}") for k in range(hubs)])
    chosen = settle(chosen.select("sign", F.explode(F.array_distinct(F.array(*[f"hub{k}" for k in range(hubs)]))).alias("b")), "hubs")
    return known.where("root <> largest").join(chosen, "sign").select(F.col("node").alias("a"), "b")


def jaccard_classes(
    docs: DataFrame, width: int = 5, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, n_shingles, component_id) of every row; component_id is the smallest id reachable by links.

    Two texts link if their sets of ``width``-word shingles (lower-cased; fewer words are one shingle) have a
    Jaccard similarity of at least 4/5.  Texts of one set are one node.  Nodes of which too many elements
    occur nowhere else are dropped first, by a part of the domain and then by all elements of what is left
    (``_candidates``, ``_may_pair``).  The others get the PartEnum signatures of their size
    band and of the next one, so that every linked pair shares one (``scheme``, ``signatures``).

    Of each bucket, every member is first compared with the bucket's smallest node, of its several buckets the one it
    shares most signatures with; that joins true groups without listing their pairs.  Buckets whose members
    are then still in several classes are opened: up to eight members all pairs across classes; beyond that those outside
    the largest class are compared with eight of it, and what even then is in several classes goes through one more
    exact join (``_rest``).  Every candidate is checked on its whole set.  So no bucket is
    capped and every link between classes is found.

    Shingles are compared by 64-bit hashes.  Missing texts and texts without words have no shingles and link with nothing.
    Very long texts are whole sets like others.  Rows that share an id are one document to the links: their component is
    that of either.  A row without an id links others and has the component they give it, which is missing if
    none has an id.  Repeated rows each get a row, other columns are not read, an empty table gives no rows.
    """
    # texts are lower-cased where they are cut into words: Spark's translate took longer than all else in these passes
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"), digest(F.col(text_col)).alias("copy"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    probed = settle(rows.mapInArrow(_sketcher(width), SKETCH_DDL), "shingle-sketches")
    sketches = settle(probed.drop("probe"), "distinct-keys")
    # a missing id never stands for a set that also has a row with one
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "copy"))
    nodes = settle(
        sketches.where("n > 0").groupBy("same", "n").agg(first.alias("first"))
        .select(F.monotonically_increasing_id().alias("node"), "same", "n", "first.id", "first.copy"), "distinct-sets")
    chosen = _candidates(_named(probed), _named(nodes))
    release(probed)
    picked = chosen.select("node", "id", "copy")
    # an id and a copy name one node, so that the repeated rows are dropped where the join has put them
    whole = settle(
        _sieve(_named(rows), ["id", "copy"], picked).join(picked, ["id", "copy"]).dropDuplicates(["id", "copy"])
        .select("node", "text").mapInArrow(_lister(width), WHOLE_DDL), "whole-sets")
    paired = _may_pair(whole.select("node", F.explode("elements").alias("element")), chosen, "paired-candidates")
    sets = settle(_sieve(whole, ["node"], paired.select("node")).mapInArrow(_sign, SIGNED_DDL), "signed-sets")
    release(whole)

    signs = sets.select("node", F.explode("signs").alias("sign"))
    shared = settle(
        signs.groupBy("sign").agg(F.min("node").alias("hub"), F.max("node").alias("far")).where("hub < far").select("sign", "hub"),
        "shared-signatures")
    members = settle(signs.join(shared, "sign").select("sign", "node", "hub"), "bucket-members")
    met = members.where("node <> hub").groupBy("node", "hub").count()
    best = met.groupBy("node").agg(F.max(F.struct("count", F.col("hub").alias("b")))["b"].alias("b"))
    links = _linked(best.withColumnRenamed("node", "a"), sets)
    roots = components(links)

    mixed = _mixed_members(members.select("sign", "node"), roots)
    few = mixed.where(F.col("size") <= FEW)
    left = few.select("sign", F.col("node").alias("a"), F.col("root").alias("root_a"))
    right = few.select("sign", F.col("node").alias("b"), F.col("root").alias("root_b"))
    listed = left.join(right, "sign").where("root_a < root_b").select("a", "b")
    large = mixed.where(F.col("size") > FEW).drop("size")
    links = links.unionByName(_linked(listed.unionByName(_outsiders(large, HUBS)), sets))
    roots = components(links)
    left = _mixed_members(large.select("sign", "node"), roots)
    if not left.isEmpty():
        open_nodes = settle(left.select("node", "root").distinct(), "open-nodes")
        more = _linked(_rest(open_nodes, sets), sets)
        roots = components(links.unionByName(more))

    # classes of sets, joined further by ids that stand in several sets
    of = sketches.where("n > 0").select("id", "same").distinct().join(nodes.select("same", "node"), "same").join(
        roots, "node", "left").select("id", "same", F.coalesce("root", "node").alias("root"))
    of = settle(of, "set-classes")
    several = of.where("id IS NOT NULL").groupBy("id").agg(
        F.min("root").alias("b"), F.max("root").alias("far")).where("b < far").select("id", "b")
    again = settle(of.join(several, "id").select(F.col("root").alias("a"), "b"), "ids-in-several-sets")
    if not again.isEmpty():
        of = of.join(components(again).select(F.col("node").alias("root"), F.col("root").alias("joined")), "root", "left").select(
            "id", "same", F.coalesce("joined", "root").alias("root"))
    least = settle(of.groupBy("root").agg(F.min("id").alias("component_id")), "class-ids")
    classes = settle(of.join(least, "root").select("same", "component_id").distinct(), "classes-of-sets")
    return sketches.select("id", "same", "n").join(classes, "same", "left").select(
        "id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def _named(df: DataFrame) -> DataFrame:
    """The rows with a number in place of a missing id, only to join on."""
    return df.withColumn("id", F.coalesce("id", F.lit(-(2**63) + 1)))


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles and component of every document at a similarity of 0.8."""
    found = jaccard_classes(documents(spark, sf_dir, "doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")
