"""Near-duplicate classes by ProbMinHash over weighted word shingles, banding and exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalith.llm.common import digest, documents, free_name
from catalith.llm.lines import NO_ID
from catalith.llm.quality import HASHES, MIX, rolled
from catalith.session import settle

REGISTERS, BAND = 96, 4
ARROW_SKETCH = pa.schema([
    ("id", pa.int64()), ("node", pa.binary()), ("registers", pa.binary()), ("bands", pa.list_(pa.int64()))])


def shingles(text: str | bytes, width: int) -> np.ndarray:
    """64-bit hashes of all windows of ``width`` words; of all words, if there are fewer; none without words."""
    words = HASHES.of((text.encode() if isinstance(text, str) else text).split())
    return rolled(words, min(width, len(words))) if len(words) else words


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prob_minhash(hashes: np.ndarray, weights: np.ndarray, doc: np.ndarray, n_docs: int, k: int = REGISTERS) -> np.ndarray:
    """Signatures of ``n_docs`` weighted sets, all given as flat arrays; (n_docs, k) element hashes.

    Every element is a Poisson process whose rate is its weight; each arrival falls into one register,
    which keeps the element of its earliest arrival.  Two sets agree in a register with the probability
    Jaccard similarity.  Round by round each element makes its next arrival, and it stops for good
    once that is later than the latest register of its set, so few elements go beyond a round or two.
    """
    best, found = np.full(n_docs * k, np.inf), np.zeros(n_docs * k, np.uint64)
    limit, time, active, turn = np.full(n_docs, np.inf), np.zeros(len(hashes)), np.arange(len(hashes)), 0
    single = np.bincount(doc, minlength=n_docs)[doc] == 1  # its only element has every register
    found.reshape(n_docs, k)[doc[single]] = hashes[single, None]
    active = active[~single]
    while len(active):
        turn += 1
        draw = _mixed(hashes[active] + np.uint64(turn * 0x9E3779B97F4A7C15 % 2**64))
        time[active] -= np.log(((draw >> np.uint64(11)).astype(np.float64) + 1) / 2**53) / weights[active]
        stay = time[active] < limit[doc[active]]
        active, draw = active[stay], draw[stay]
        at = doc[active] * k + (_mixed(draw ^ MIX) % np.uint64(k)).astype(np.int64)
        now = time[active]
        np.minimum.at(best, at, now)
        won = best[at] == now
        found[at[won]] = hashes[active[won]]
        touched = np.unique(doc[active])
        limit[touched] = best.reshape(n_docs, k)[touched].max(axis=1)
    return found.reshape(n_docs, k)


def _sketcher(width: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(at, 250) for at in range(0, batch.num_rows, 250)):
                sets = [np.unique(shingles(t, width), return_counts=True) for t in part.column(2).to_pylist()]
                sizes = np.array([len(s[0]) for s in sets])
                hashes, counts = (np.concatenate(c) for c in zip(*sets))
                found = prob_minhash(
                    hashes, 1 + np.log(counts), np.repeat(np.arange(len(sets)), sizes), len(sets))
                bands = found.reshape(len(sets), -1, BAND)
                keys = np.arange(bands.shape[1], dtype=np.uint64) + np.uint64(1)
                keys = np.broadcast_to(keys, bands.shape[:2]).copy()
                for i in range(BAND):
                    keys = _mixed(keys * MIX ^ bands[:, :, i])
                registers = _mixed(found).astype("<u2")  # 16 bits each are enough to compare
                columns = [
                    part.column(0), part.column(1).cast(pa.binary()),
                    pa.array([r.tobytes() for r in registers], pa.binary()),
                    pa.array([k if n else [] for k, n in zip(keys.view(np.int64).tolist(), sizes)], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=ARROW_SKETCH)

    return sketch


def _agreeing(share: float):
    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2").reshape(-1, REGISTERS) for i in (2, 3))
            close = (a == b).sum(axis=1) >= share * REGISTERS
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(close)), batch.column(1).filter(pa.array(close))], names=["a", "b"])

    return agree


def _verifier(width: int, threshold: float):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, None
        for batch in batches:
            close = []
            for part in (batch.slice(at, 500) for at in range(0, batch.num_rows, 500)):
                for x, y in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                    if x != last:  # pairs of one hub follow each other
                        last, last_set = x, np.unique(shingles(x, width))
                    other = np.unique(shingles(y, width))
                    common = len(np.intersect1d(last_set, other, assume_unique=True))
                    close.append(common >= threshold * (len(last_set) + len(other) - common))
            keep = pa.array(close, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    return verify


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each connected component, for all nodes that have an edge.

    In each round every node follows that node among itself and its neighbours whose hash is smallest, and the one
    that it follows in turn; edges are drawn between those instead, and edges inside one node go.  The node with the
    largest hash always goes.  A star takes two rounds; hashes change every four, so that no order of the nodes makes
    chains go slowly.  Minima are combined before any shuffle, and a node with very many neighbours stands on the
    side of the joins that can be split.
    """
    e = settle(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v"), "links")
    if e.isEmpty():
        return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots, turn = None, 0
    while roots is None or not e.isEmpty():
        mark = lambda c: F.xxhash64(c, F.lit(turn // 4))  # noqa: B023, E731
        both = e.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("x"))
        followed = settle(
            both.select("x.u", "x.v").groupBy("u").agg(F.min(mark("v")).alias("mark"), F.min_by("v", mark("v")).alias("v"))
            .select(F.col("u").alias("node"), F.when(F.col("mark") < mark("u"), F.col("v")).otherwise(F.col("u")).alias("root")),
            "followed")
        followed = settle(_renamed(followed, followed), "followed")
        of = lambda name: followed.select(F.col("node").alias(name), F.col("root").alias(f"root_{name}"))  # noqa: B023, E731
        e = settle(e.join(of("u"), "u").join(of("v"), "v").select(
            F.col("root_u").alias("u"), F.col("root_v").alias("v")).where("u <> v"), "links")
        roots = followed if roots is None else _renamed(roots, followed)
        turn += 1
    roots = settle(roots, "followed") if turn > 1 else roots
    # written, because a join with an aggregate in the same stage cannot be split where a component is large
    least = settle(roots.groupBy("root").agg(F.min("node").alias("least")), "least-nodes")
    return settle(roots.join(least, "root").select("node", F.col("least").alias("root")), "components")


def _renamed(roots: DataFrame, further: DataFrame) -> DataFrame:
    """(node, root) with the root that ``further`` gives each root, where it knows it."""
    further = further.select(F.col("node").alias("root"), F.col("root").alias("further"))
    return roots.join(further, "root", "left").select("node", F.coalesce("further", "root").alias("root"))


def _with_links(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The components (see there) when ``links`` (a, b) are added; only the classes that these touch are joined anew."""
    of = lambda name: roots.select(F.col("node").alias(name), F.col("root").alias(f"root_{name}"))
    across = components(links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(
        F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")))
    alone = across.join(roots.select("node"), "node", "left_anti")
    return settle(_renamed(roots, across).unionByName(alone), "components")


def _links(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, width: int, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts reach ``threshold``, first by their registers, then exactly."""
    pairs = pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    of = lambda df, column, name: df.select(F.col("node").alias(name), F.col(column).alias(f"{column}_{name}"))
    close = settle(
        pairs.join(of(nodes, "registers", "a"), "a").join(of(nodes, "registers", "b"), "b")
        .select("a", "b", "registers_a", "registers_b")
        .mapInArrow(_agreeing(threshold - 0.25), "a binary, b binary"), "close-pairs")
    wanted = close.select(F.col("a").alias("node")).unionByName(close.select(F.col("b").alias("node"))).distinct()
    text = settle(texts.join(wanted.join(nodes.select("node", "id"), "node"), ["node", "id"]).select("node", "text"), "pair-texts")
    return settle(
        close.join(of(text, "text", "a"), "a").join(of(text, "text", "b"), "b").select("a", "b", "text_a", "text_b")
        .mapInArrow(_verifier(width, threshold), "a binary, b binary"), "near-links")


def _mixed_buckets(large: DataFrame, roots: DataFrame) -> DataFrame:
    """(cell, node, root, largest) of the large buckets whose members are in several classes."""
    known = settle(large.select("cell", "node").join(roots, "node", "left").select(
        "cell", "node", F.coalesce("root", "node").alias("root")), "large-buckets")
    # written, because a join with an aggregate in the same stage cannot be split where a bucket is hot
    several = settle(known.groupBy("cell", "root").count().groupBy("cell").agg(
        F.count("*").alias("classes"), F.max(F.struct("count", "root"))["root"].alias("largest"))
        .where("classes > 1").select("cell", "largest"), "mixed-cells")
    return settle(known.join(several, "cell"), "mixed-buckets")


def _shingle_lists(width: int):
    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(shingles(t, width)).view(np.int64) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))], names=["node", "root", "shingles"])

    return lists


def _overlap_pairs(open_nodes: DataFrame, nodes: DataFrame, texts: DataFrame, width: int, threshold: float) -> DataFrame:
    """All pairs of open nodes of different classes that can reach ``threshold``: an exact prefix join.

    Each text's shingles stand in order of how many open texts have them, the rarest first.  Two
    texts that reach t share one among the first s - ceil(t s) + 1 shingles of the longer and the first
    s - ceil(2 t s / (1 + t)) + 1 of the shorter.  Shingles of one text lead to no pair and fill these
    prefixes first, so texts that only have a passage in common do not meet.  In a shingle's list, the
    members outside its largest class meet the members of other classes.
    """
    t = threshold
    ids = open_nodes.join(nodes.select("node", "id"), "node")
    lists = settle(
        texts.join(ids, ["node", "id"]).dropDuplicates(["node"]).select("node", "root", "text")
        .mapInArrow(_shingle_lists(width), "node binary, root binary, shingles array<bigint>"), "shingle-lists")
    flat = lists.select("node", F.explode("shingles").alias("shingle"))
    often = flat.groupBy("shingle").agg(F.count("*").alias("texts")).where("texts > 1")
    held = settle(flat.join(often, "shingle"), "shared-shingles")
    place = Window.partitionBy("node").orderBy("texts", "shingle")
    shared = held.groupBy("node").agg(F.count("*").alias("shared"))
    sizes = lists.select("node", "root", F.size("shingles").alias("size")).join(shared, "node")
    rare = F.col("size") - F.col("shared")
    ranked = held.withColumn("rank", F.row_number().over(place)).join(sizes, "node").withColumn("rank", F.col("rank") + rare)
    exact = 1e-9  # so that a rounding error lengthens a prefix and never shortens it
    prefix = settle(
        ranked.where(F.col("rank") <= F.col("size") - F.ceil(t * F.col("size") - exact) + 1)
        .withColumn("shorter", F.col("rank") <= F.col("size") - F.ceil(2 * t / (1 + t) * F.col("size") - exact) + 1)
        .select("shingle", "node", "root", "size", "shorter"), "prefixes")
    lead = (
        prefix.groupBy("shingle", "root").count().groupBy("shingle")
        .agg(F.count("*").alias("classes"), F.max(F.struct("count", "root"))["root"].alias("largest"))
        .where("classes > 1").drop("classes"))
    listed = settle(prefix.join(lead, "shingle"), "mixed-lists")
    other = listed.select("shingle", *[F.col(c).alias(f"{c}_b") for c in ("node", "root", "size", "shorter")])
    fits = (
        (F.col("root") != F.col("root_b"))
        & (F.least("size", "size_b") >= t * F.greatest("size", "size_b") - exact)
        & F.when(F.col("size") < F.col("size_b"), F.col("shorter")).when(
            F.col("size") > F.col("size_b"), F.col("shorter_b")).otherwise(F.col("shorter") & F.col("shorter_b")))
    meets = listed.where("root <> largest").join(other, "shingle").where(fits)
    return meets.select(F.col("node").alias("a"), F.col("node_b").alias("b"))


def near_classes(
    docs: DataFrame, threshold: float = 0.8, width: int = 5, small: int = 12, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, node, class_id, class_node) of every row: node is the text's digest, class_id the class's smallest id.

    Two texts are linked if the Jaccard similarity of their sets of ``width``-word shingles reaches
    ``threshold``; classes are the connected components.  Equal texts are one node and are never paired.
    Signatures of 96 registers (shingles weigh 1 + ln of their count) in 24 bands of 4 find a pair at
    0.8 with a chance of 1 - 3e-6.

    Pairs of a bucket: all, where it has at most ``small`` members; else each member with three members
    chosen by hash, which links a true group.  In buckets that then still hold several classes, every member
    outside the largest class is compared with four members of it.  Texts of buckets that even then hold
    several classes go through an exact prefix join over their shingles (``_overlap_pairs``).  So nothing is
    capped, a bucket of one class costs no pairs, and neither do texts that only share a passage.  Pairs are
    thinned by their registers (six standard errors below the threshold) before texts are fetched.

    Missing texts are empty.  Texts of fewer than ``width`` words are one shingle; texts without words
    are only equal to texts of the same characters.  A missing id counts as the largest (``NO_ID``);
    rows that share an id and text are one document.  An empty table gives no rows.
    """
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("id"), digest(F.col(text_col)).alias("node"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sketches = settle(
        rows.mapInArrow(_sketcher(width), "id bigint, node binary, registers binary, bands array<bigint>"), "sketches")
    nodes = settle(sketches.groupBy("node").agg(
        F.min("id").alias("id"), F.first("registers").alias("registers"), F.first("bands").alias("bands")), "texts-once")
    texts = rows.select("node", "id", "text")

    cells = nodes.select("node", F.explode("bands").alias("cell"))
    hub = lambda k: F.min(F.struct(F.xxhash64("node", F.lit(k)), "node"))["node"]
    shared = cells.groupBy("cell").agg(
        F.count("*").alias("n"), *[hub(k).alias(f"hub{k}") for k in range(3)]).where("n > 1")
    members = settle(cells.join(shared, "cell"), "bucket-members")
    few = members.where(F.col("n") <= small).select("cell", F.col("node").alias("a"))
    pairs = few.join(few.withColumnRenamed("a", "b"), "cell").where("a < b").select("a", "b")
    large = members.where(F.col("n") > small)
    hubs = large.select(F.col("node").alias("a"), F.explode(F.array("hub0", "hub1", "hub2")).alias("b"))
    roots = components(_links(pairs.unionByName(hubs), nodes, texts, width, threshold))

    # buckets that still hold several classes: first their outsiders with members of the largest class
    mixed = _mixed_buckets(large, roots)
    inner = mixed.where("root = largest").groupBy("cell").agg(*[hub(k).alias(f"hub{k}") for k in range(3, 7)])
    again = mixed.where("root <> largest").join(inner, "cell").select(
        F.col("node").alias("a"), F.explode(F.array("hub3", "hub4", "hub5", "hub6")).alias("b"))
    roots = _with_links(roots, _links(again, nodes, texts, width, threshold))
    # then whatever is left, exactly
    open_nodes = settle(_mixed_buckets(large, roots).select("node", "root").distinct(), "open-nodes")
    rest = _overlap_pairs(open_nodes, nodes, texts, width, threshold)
    more = _links(rest, nodes, texts, width, threshold)
    if not more.isEmpty():
        roots = _with_links(roots, more)

    classed = nodes.select("node", "id").join(roots, "node", "left").select(
        "node", "id", F.coalesce("root", "node").alias("root"))
    first = classed.groupBy("root").agg(F.min(F.struct("id", "node")).alias("first"))
    chosen = settle(classed.join(first, "root").select(
        "node", F.col("first.id").alias("class_id"), F.col("first.node").alias("class_node")), "near-classes")
    return sketches.select("id", "node").join(chosen, "node")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents without near copies: of every class the row with the smallest id stays.

    Of rows that share id and text one stays.  See ``near_classes``.
    """
    classes = near_classes(docs, id_col=id_col, text_col=text_col, **options)
    stays = classes.where("id = class_id AND node = class_node")
    id_key, node_key = free_name(docs, "id_key"), free_name(docs, "node_key")
    keys = stays.select(F.col("id").alias(id_key), F.col("node").alias(node_key)).distinct()
    kept = docs.withColumn(id_key, F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID))).withColumn(
        node_key, digest(F.col(text_col))).join(keys, [id_key, node_key])
    if not stays.groupBy("id", "node").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates([id_key, node_key])
    return kept.select(*[f"`{c}`" for c in docs.columns])


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document."""
    classes = near_classes(documents(spark, sf_dir, "doc_id", "text"))
    return classes.select(
        F.nullif("id", F.lit(NO_ID)).alias("doc_id"), F.nullif("class_id", F.lit(NO_ID)).alias("class_id"))
