"""Mixing of sources to target weights that may change over the course of training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalith.llm.common import WORD, documents, free_name
from catalith.session import settle


def word_count(text: Column) -> Column:
    """Words of a text; none where it is missing."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def cyclic_schedule(sources: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0)) -> DataFrame:
    """Constant weights, dealt in turn to the sources in code point order, the missing one last."""
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    values = F.array(*[F.lit(float(w)) for w in weights])
    weight = F.element_at(values, (F.pmod(turn, F.lit(len(weights))) + 1).cast("int"))
    return sources.select("source", F.array(
        F.struct(F.lit(0.0).alias("t"), weight.alias("w")), F.struct(F.lit(1.0).alias("t"), weight.alias("w")),
    ).alias("knots"))


def source_targets(sizes: DataFrame, schedule: DataFrame, max_repeat: int = 3) -> DataFrame:
    """Target of each source: total shared by integrated weight, at most ``max_repeat`` times its size.

    ``sizes`` has (source, source_size), ``schedule`` (source, knots): weights at times from 0 to 1,
    linear in between.  What a limited source cannot take is shared again by weight, until no source
    is above its limit: with the sources in order of limit over weight, that level is found from
    running sums.  There is one row per source, and only these go through one window.
    """
    area = F.expr(
        "aggregate(sequence(2, size(knots)), 0D, (sum, i) -> sum + (knots[i - 1].t - knots[i - 2].t) "
        "* (knots[i - 1].w + knots[i - 2].w) / 2)")
    limit = F.col("source_size") * max_repeat
    ratio = F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).otherwise(float("inf"))
    rows = (
        sizes.join(schedule.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
        .drop("_source").withColumn("weight", area).withColumn("cap", limit.cast("double")).withColumn("ratio", ratio))
    order = Window.orderBy(F.col("ratio"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    shared = F.sum("weight").over(after)
    rows = rows.withColumn("level", F.when(shared > 0, level / shared))
    rows = rows.withColumn("level", F.min(F.when(
        F.col("level") <= F.col("ratio"), F.struct("ratio", F.col("source").isNull(), "source", "level"))
    ).over(everything)["level"])
    target = F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.when(F.col("weight") > 0, F.col("cap")).otherwise(0.0)))
    return rows.select("source", "source_size", "knots", "weight", target.alias("target"))


def assign(
    docs: DataFrame, keep: list[str], schedule: DataFrame | None = None, max_repeat: int = 3,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", buckets: int = 4096,
) -> DataFrame:
    """How often each document is taken and when.

    Gives ``row`` (a struct of the columns ``keep``), size (words), source_size, target, copies and
    positions (one training time from 0 to 1 per copy).  A source's documents stand in the order of
    the MD5 of their id.  They are taken in whole passes while the target allows, then up to the
    document whose middle passes the rest; the one document whose size comes closest to what is
    still missing (or too much) is then added (or left out), if that brings the source closer.  A copy's
    cumulative demand is turned into a time by inverting the integral of the source's schedule.

    Running sums come from sums per (source, ``buckets`` hash ranges) and a window inside each, so a
    source with a third of all rows is spread over all tasks.  ``schedule`` has (source, knots), see
    ``source_targets``; by default the weights 1, 2, 3 in turn.  Missing texts have no words, a
    missing source is one of its own, rows with equal or missing ids are documents of their own, and
    an empty table gives no rows.  Documents without words are taken in whole passes only.
    """
    rank = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    rows = docs.select(
        F.struct(*keep).alias("row"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        rank.alias("rank"))
    # a running order needs ordered buckets: ranges of the rank
    rows = rows.withColumn("bucket", F.floor(F.conv(F.substring("rank", 1, 6), 16, 10).cast("bigint") * buckets / 2**24))
    slim = settle(rows.select("source", "bucket", "rank", "size"), "mix-sizes")
    sums = settle(slim.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "mix-buckets")
    sizes = sums.groupBy("source").agg(F.sum("words").alias("source_size"))
    if schedule is None:
        schedule = cyclic_schedule(sizes.select("source"))
    targets = settle(source_targets(sizes, schedule, max_repeat).withColumn(
        "passes", F.least(F.lit(max_repeat), F.when(
            F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(1))).withColumn(
        "rest", F.col("target") - F.col("passes") * F.col("source_size")), "mix-targets")
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("base", F.coalesce(F.sum("words").over(running), F.lit(0)))
    inside = Window.partitionBy("source", "bucket").orderBy("rank", "size").rowsBetween(Window.unboundedPreceding, -1)

    o, t = offsets.alias("o"), targets.alias("t")
    bases = o.join(t, F.col("o.source").eqNullSafe(F.col("t.source"))).select(
        "o.source", "o.bucket", "o.base", "t.passes", "t.rest", "t.target", "t.source_size", "t.knots", "t.weight")

    def placed(part: DataFrame) -> DataFrame:
        """Running words before each row, and whether the last, partial pass takes it."""
        p = part.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0))).alias("p")
        b = bases.alias("b")
        out = p.join(b, F.col("p.source").eqNullSafe(F.col("b.source")) & (F.col("p.bucket") == F.col("b.bucket")))
        out = out.select(
            "p.*", (F.col("b.base") + F.col("p.within")).alias("before"), "b.passes", "b.rest", "b.target",
            "b.source_size", "b.knots", "b.weight")
        return out.withColumn("partial", (F.col("size") > 0) & (
            2 * F.col("before") + F.col("size") <= 2 * F.col("rest")))

    taken = settle(placed(slim).select("source", "size", "before", "partial", "rest"), "mix-partial")
    gaps = taken.groupBy("source").agg(
        (F.first("rest") - F.sum(F.when(F.col("partial"), F.col("size")).otherwise(0))).alias("gap"))
    g, p = gaps.alias("g"), taken.alias("p")
    off = F.abs(F.col("size") - F.abs(F.col("gap")))
    fixes = settle(
        p.join(g, F.col("p.source").eqNullSafe(F.col("g.source"))).select("p.*", "g.gap")
        .where((F.col("size") > 0) & (F.col("partial") == (F.col("gap") < 0)) & (off < F.abs(F.col("gap"))))
        .groupBy("source").agg(F.min(F.struct(off.alias("off"), F.col("before").alias("at"))).alias("best"))
        .select("source", F.col("best.at").alias("fix")), "mix-fixes")
    f, r = fixes.alias("f"), placed(rows).alias("r")
    final = r.join(f, F.col("r.source").eqNullSafe(F.col("f.source")), "left").select("r.*", "f.fix")
    flipped = F.col("partial") != ((F.col("size") > 0) & F.coalesce(F.col("before") == F.col("fix"), F.lit(False)))
    final = final.withColumn("copies", (F.col("passes") + flipped.cast("int")).cast("int"))
    demand = "coalesce(least(try_divide(i * source_size + before + size / 2, target), 1D), 0D)"
    return final.select(
        "row", "size", "source_size", "target", "copies", _positions(demand).alias("positions"))


def _positions(demand: str) -> Column:
    """For every copy, when its source has used up the share ``demand`` of its integrated weight.

    Finds the segment of the schedule by running area and solves the quadratic that a linear weight gives.
    """
    t0, t1, w0, w1 = "knots[k - 2].t", "knots[k - 1].t", "knots[k - 2].w", "knots[k - 1].w"
    area = f"(({t1} - {t0}) * ({w1} + {w0}) / 2)"
    slope = f"(({w1} - {w0}) / ({t1} - {t0}))"
    x = (f"least({t1} - {t0}, CASE WHEN s.left <= 0 THEN 0D ELSE 2 * s.left / "
         f"({w0} + sqrt(greatest({w0} * {w0} + 2 * {slope} * s.left, 0D))) END)")
    fold = (
        f"aggregate(sequence(2, size(knots)), named_struct('left', {demand} * weight, 'at', CAST(NULL AS DOUBLE)), "
        f"(s, k) -> named_struct('left', greatest(s.left - {area}, 0D), 'at', CASE WHEN s.at IS NOT NULL THEN s.at "
        f"WHEN s.left <= {area} THEN {t0} + {x} END), s -> coalesce(s.at, 1D))")
    return F.expr(f"CASE WHEN copies > 0 THEN transform(sequence(0, copies - 1), i -> {fold}) ELSE array() END")


def in_order(assigned: DataFrame) -> DataFrame:
    """One row per copy of the assigned documents, in training order: ``at`` in place of positions.

    Rows are dealt to tasks by ranges of position and sorted inside each.
    """
    others = [c for c in assigned.columns if c != "positions"]
    copies = assigned.select(*others, F.explode("positions").alias("at"))
    return copies.repartitionByRange("at").sortWithinPartitions("at")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The documents in training order: one row per copy, with the columns of ``docs`` and position.

    See ``assign`` and ``in_order``.
    """
    at = free_name(docs, "position")
    mixed = in_order(assign(docs, docs.columns, **options).select("row", "positions"))
    return mixed.select("row.*", F.col("at").alias(at))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes from every document, with sources weighted 1, 2, 3 in turn.

    The mix is written in training order, and what it takes is counted there; documents it leaves out follow
    from the assignment.  Rows are told apart by place, as ids may repeat.
    """
    docs = documents(spark, sf_dir, "doc_id", "text", "source").withColumn("place", F.monotonically_increasing_id())
    assigned = settle(assign(docs, ["doc_id", "place"]), "mix-assigned")
    mixed = settle(in_order(assigned.select("row.place", "size", "positions")), "mix-in-order")
    taken = mixed.groupBy("place").agg(F.sum("size").alias("taken"), F.min("at").alias("first_position"))
    return assigned.select("row.*", "size", "source_size", "target").join(taken, "place", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("bigint")).alias("taken"), "first_position")


SQL = r"""
WITH docs AS (
  SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '')) AS rank,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
), sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::DOUBLE AS cap,
    ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight
  FROM docs GROUP BY source
), levels AS (
  SELECT *, cap / weight AS ratio,
    (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sizes
), leveled AS (
  SELECT source, source_size, weight, least(cap, coalesce(
    (SELECT level FROM levels WHERE level <= ratio ORDER BY ratio, source NULLS LAST LIMIT 1) * weight, cap)) AS target
  FROM levels
), targets AS (
  SELECT *, target - passes * source_size AS rest FROM (
    SELECT *, least(3, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 1 END)::BIGINT AS passes
    FROM leveled)
), placed AS (
  SELECT *, size > 0 AND 2 * before + size <= 2 * rest AS partial FROM (
    SELECT d.*, t.source_size, t.weight, t.target, t.passes, t.rest,
      coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY rank, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
    FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
), gaps AS (
  SELECT source AS gap_source, any_value(rest) - sum(CASE WHEN partial THEN size ELSE 0 END) AS gap
  FROM placed GROUP BY source
), fixes AS (
  SELECT gap_source AS fix_source, arg_min(before, (abs(size - abs(gap)), before)) AS fix
  FROM placed JOIN gaps ON source IS NOT DISTINCT FROM gap_source
  WHERE size > 0 AND partial = (gap < 0) AND abs(size - abs(gap)) < abs(gap) GROUP BY gap_source
), counted AS (
  SELECT p.*, (passes + CASE WHEN partial <> (size > 0 AND coalesce(before = fix, false)) THEN 1 ELSE 0 END) AS copies
  FROM placed p LEFT JOIN fixes ON source IS NOT DISTINCT FROM fix_source
)
SELECT doc_id, size, source_size, target, copies * size AS taken,
  CASE WHEN copies > 0 THEN least(1.0::DOUBLE, CASE WHEN before + size = 0 THEN 0.0::DOUBLE ELSE
    2 * (least((before + size / 2) / target, 1.0::DOUBLE) * weight)
      / (weight + sqrt(weight * weight)) END) END AS first_position
FROM counted
"""
