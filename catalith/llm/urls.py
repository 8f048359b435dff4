"""URL verdicts: host and path rules first, then a tree of path templates with labelled purity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalith.llm.lines import LOWER, UPPER
from catalith.session import settle

PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
RULES = (
    ("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"),
)
STOP = "\x00"  # where a path has no further segment


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, ASCII letters in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty where there is no host."""
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def rule_match(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits host (or a parent domain) and path; else missing."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, domain, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(start)
        rule = F.when(fits, F.lit(domain + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def shape(path: Column) -> Column:
    """Segments of a path with ids generalised: long hexadecimal names and runs of digits become ``#``."""
    segments = F.filter(F.split(path, "/", -1), lambda s: s != "")
    return F.transform(segments, lambda s: F.when(s.rlike("^[0-9a-fA-F-]{16,}$"), "#").otherwise(
        F.regexp_replace(s, "[0-9]+", "#")))


def _differs(a: Column, n: Column, b: Column, m: Column, z: float) -> Column:
    """Whether two shares a/n and b/m differ by more than ``z`` standard errors (smoothed by one each)."""
    p, q = (a + 1) / (n + 2), (b + 1) / (m + 2)
    both = (a + b + 2) / (n + m + 4)
    return F.abs(p - q) > z * F.sqrt(both * (1 - both) * (1 / (n + 2) + 1 / (m + 2)))


def template_tree(
    pages: DataFrame, depth: int = 4, min_count: int = 20, min_share: float = 0.02, z: float = 3.0,
) -> DataFrame:
    """The template of every (host, shape): pages has host, shape, n, labelled, bad.

    Level by level, below each template prefix of a host, a segment stays as it is if at least
    ``min_count`` pages and ``min_share`` of its node have it; all others become ``*``.  Of the
    segments that stay (at most 1 / ``min_share`` per node) neighbours in order of their bad rate are
    merged into one branch ``{a|b}`` unless bad rate or share of longer paths differ by ``z`` standard
    errors.  Segments beyond ``depth`` become ``**``.  Everything is counted from sums per branch, so
    a hot host sends one row per branch and task.
    """
    state = pages.withColumn("template", F.lit(""))
    levels = min(depth, state.agg(F.coalesce(F.max(F.size("shape")), F.lit(0))).first()[0])
    for level in range(1, levels + 1):
        segment = F.when(F.size("shape") >= level, F.get("shape", F.lit(level - 1))).otherwise(STOP)
        state = state.withColumn("segment", segment)
        branches = settle(state.groupBy("host", "template", "segment").agg(
            F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"),
            F.sum(F.when(F.size("shape") > level, F.col("n")).otherwise(0)).alias("longer")), "url-branches")
        nodes = branches.groupBy("host", "template").agg(F.sum("n").alias("node"))
        stay = branches.where(F.col("segment") != STOP).where(F.col("n") >= min_count).join(
            nodes, ["host", "template"]).where(F.col("n") >= min_share * F.col("node"))
        order = Window.partitionBy("host", "template").orderBy(
            (F.col("bad") + 1) / (F.col("labelled") + 2), F.col("longer") / F.col("n"), "segment")
        before = lambda c: F.lag(c).over(order)
        apart = F.coalesce(
            _differs(F.col("bad"), F.col("labelled"), before("bad"), before("labelled"), z)
            | _differs(F.col("longer"), F.col("n"), before("longer"), before("n"), z), F.lit(False))
        stay = stay.withColumn("apart", apart.cast("int")).withColumn("branch", F.sum("apart").over(order))
        merged = Window.partitionBy("host", "template", "branch")
        names = F.array_sort(F.collect_list("segment").over(merged))
        stay = settle(stay.select("host", "template", "segment", F.when(
            F.size(names) > 1, F.concat(F.lit("{"), F.array_join(names, "|"), F.lit("}"))
        ).otherwise(F.col("segment")).alias("name")), "url-names")
        step = F.when(F.col("segment") == STOP, "").otherwise(
            F.concat(F.lit("/"), F.coalesce(F.col("name"), F.lit("*"))))
        state = settle(state.join(stay, ["host", "template", "segment"], "left").select(
            "host", "shape", "n", "labelled", "bad", F.concat("template", step).alias("template")), "url-state")
    return state.withColumn("template", F.concat("template", F.when(F.size("shape") > levels, "/**").otherwise("")))


def url_verdicts(
    pages: DataFrame, labels: DataFrame, rules=RULES, threshold: float = 0.5, prior: float = 10.0,
    id_col: str = "page_id", url_col: str = "url", **tree,
) -> DataFrame:
    """Host, path, rule and verdict of each page's url.

    ``labels`` has (id, bad): 1 for bad pages, 0 for good ones; ids with both count as bad.  Pages
    that no rule judges get the verdict of their path template (``template_tree``): block if its
    smoothed purity, the share of good pages among the labelled ones, is below ``threshold``.  Purity is
    smoothed towards the host's with a weight of ``prior`` pages, the host's towards that of all.
    Without any labels nothing is blocked.

    Gives id_col, host, path, rule, verdict, template, purity.  A missing url, or one without ``://``, has an
    empty host and path.  Repeated rows each get a row, missing ids are kept and unlabelled, an empty
    table gives no rows, other columns are not read.
    """
    url = F.col(url_col)
    parsed = pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    parsed = parsed.withColumn("shape", shape(F.col("path")))
    known = labels.where("id IS NOT NULL AND bad IS NOT NULL").groupBy("id").agg(F.max("bad").cast("bigint").alias("bad"))
    shapes = settle(
        parsed.join(known, "id", "left").groupBy("host", "shape").agg(
            F.count("*").alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")),
        "url-shapes")
    tree_rows = template_tree(shapes, **tree)
    sums = [F.sum(c).alias(c) for c in ("labelled", "bad")]
    templates = tree_rows.groupBy("host", "template").agg(*sums)
    hosts = shapes.groupBy("host").agg(F.sum("labelled").alias("host_labelled"), F.sum("bad").alias("host_bad"))
    # one row of two sums
    labelled, bad = shapes.agg(F.coalesce(F.sum("labelled"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    overall = F.lit((labelled - bad + prior) / (labelled + prior))
    host_purity = (F.col("host_labelled") - F.col("host_bad") + prior * overall) / (F.col("host_labelled") + prior)
    purity = (F.col("labelled") - F.col("bad") + prior * host_purity) / (F.col("labelled") + prior)
    judged = templates.join(hosts, "host").select("host", "template", purity.alias("purity"))
    by_shape = tree_rows.select("host", "shape", "template").join(judged, ["host", "template"])
    rule, verdict = rule_match(F.col("host"), F.col("path"), rules)
    return parsed.join(by_shape, ["host", "shape"], "left").select(
        F.col("id").alias(id_col), "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("purity") < threshold, "block").otherwise("allow")).alias("verdict"),
        "template", "purity")


def page_labels(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, bad) of pages: the quality label of the document whose number is the url's last whole number."""
    number = F.expr("try_cast(regexp_extract(path, '/([0-9]+)[^/]*/?$', 1) AS BIGINT)")
    numbered = pages.select("page_id", path_of(F.col("url")).alias("path")).select("page_id", number.alias("doc_id"))
    return numbered.join(labels.select("doc_id", "quality"), "doc_id").select(
        F.col("page_id").alias("id"), (1 - F.col("quality")).alias("bad"))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict for every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return url_verdicts(pages, page_labels(pages, labels))
