"""Joins, picks, ranks, profiles: order, skew and partitioning."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from catalith.operators import aggregate, lookup, quality, ranks, search
from catalith.session import settle

C = F.col


@pytest.fixture
def texts(spark):
    rows = [
        (0, "a", "short"), (1, "a", "Follow 3 simple steps to get to your desired version, long"),
        (2, "a", "clean"), (3, "b", ""), (4, "b", None), (5, "c", "   "),
        (6, "d", "Follow 3 simple steps to get to your desired version"),
    ]
    return spark.createDataFrame(rows, "i bigint, k string, t string")


def both_ways(df):
    """The same rows in one and in eight partitions."""
    return df.coalesce(1), df.repartition(8, F.rand(3))


def test_best_text(texts):
    for df in both_ways(texts):
        got = dict(lookup.best_texts(df, C("k"), ["t"], "i").collect())
        assert got["a"] == "short"  # five letters twice: the first wins
        assert got["b"] == "" and got["c"] == ""
        assert got["d"].startswith("Follow")


def test_best_texts_are_fetched_late(spark):
    """Ranks are combined in hash maps; the texts are neither sorted nor aggregated, and only winners travel."""
    rows = [(i, f"k{i % 3}", f"text {i % 7} " + "x" * (i % 11), "y" * (i % 5) or None) for i in range(200)]
    rows += [(500, "k0", "z" * 40, "short"), (500, "k0", "z" * 30, "the longer one of its row")]
    df = spark.createDataFrame(rows, "i bigint, k string, t string, u string")
    best = lookup.best_texts(df, C("k"), ["t", "u"], "i")
    got = {r["join_key"]: (r["t"], r["u"]) for r in best.collect()}
    plain = {}
    for key in ("k0", "k1", "k2"):
        own = [r for r in rows if r[1] == key]
        plain[key] = tuple(
            max((r for r in own if r[c]), key=lambda r: (len(r[c].strip()), -r[0]))[c] for c in (2, 3))
    assert got == plain
    rank = df.groupBy("k").agg(F.max(lookup._text_rank(C("t"), C("i"))))
    for plan in (best._jdf.queryExecution().executedPlan().toString(), rank._jdf.queryExecution().executedPlan().toString()):
        assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_best_text_join_overwrites_with_blank(spark, texts):
    rows = spark.createDataFrame([(1, " B ", "own"), (2, "zz", "own")], "i bigint, k string, t string")
    args = (rows, C("k"), texts, C("k"), ["t"], "i")
    got = {r["i"]: r["t"] for r in lookup.best_text_join(*args).collect()}
    assert got == {1: "", 2: "own"}
    kept = {r["i"]: r["t"] for r in lookup.best_text_join(*args, keep_existing=True).collect()}
    assert kept == {1: "own", 2: "own"}


def test_first_values_and_rows(spark):
    rows = [(2, "f", "x", None), (1, "f", None, None), (3, "f", "y", "z")]
    for df in both_ways(spark.createDataFrame(rows, "i bigint, k string, a string, b string")):
        assert tuple(lookup.first_values(df, ["k"], ["a", "b"], "i").first()) == ("f", "x", "z")
        assert tuple(lookup.first_rows(df, ["k"], ["a", "b"], "i").first()) == ("f", None, None)


def test_unprocessed_keeps_rows_without_key(spark):
    rows = spark.createDataFrame([(1, "u"), (2, None), (3, "v"), (4, "v")], "i bigint, url string")
    done = spark.createDataFrame([("u",), (None,), ("u",)], "url string")
    assert sorted(r["i"] for r in lookup.unprocessed(rows, done, "url").collect()) == [2, 3, 4]


def test_attach_vectors_multiplies_and_reports(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    vecs = spark.createDataFrame([("a", "1"), ("a", "2")], "k string, v string")
    assert lookup.attach_vectors(rows, vecs, "k", ["v"]).count() == 5
    assert [tuple(r) for r in lookup.duplicate_keys(vecs, "k").collect()] == [("a", 2)]


def test_worklist_modes(spark):
    df = spark.createDataFrame(
        [(0, "a", ""), (1, "a", "5"), (2, "b", "6"), (3, "c", "")], "i bigint, k string, p string")
    cached = spark.createDataFrame([("c",)], "k string")

    def keys(**how):
        got = lookup.worklist(df, "k", "i", ["p"], cached, **how)
        return sorted(r["k"] for r in got.collect())

    assert keys() == ["a", "b"]
    assert keys(missing=C("p") == "") == ["a"]
    assert keys(force=True) == ["a", "b", "c"]


def test_hot_key_join_is_split(spark):
    """One key holds most rows: adaptive execution must cut its partition."""
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {n: spark.conf.get(n, None) for n in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        rows = spark.range(200000).select(
            F.when(C("id") % 3 == 0, -1).otherwise(C("id") % 1000).alias("k"),
            F.md5(C("id").cast("string")).alias("v")).repartition(16)
        results = rows.groupBy("k").agg(F.max("v").alias("best"))
        joined = lookup.apply_results(rows, results, "k", ["best"])
        fresh = lookup.unprocessed(rows, rows.where("k = 7"), "k")
        for df, expected in ((joined, 200000), (fresh, 200000 - rows.where("k = 7").count())):
            assert len(df.collect()) == expected
            assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def test_small_lookup_leaves_rows_unshuffled(spark):
    rows = spark.range(5000).select((C("id") % 7).alias("k"), C("id").alias("i"))
    results = rows.groupBy("k").agg(F.max("i").alias("best"))
    joined = lookup.apply_results(rows, results, "k", ["best"])
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_family_rivals(spark):
    rows = [(2, "f", "Fiat: 3/5 | Mini: 4/5"), (1, "f", "MINI: 5/5"), (3, "f", None)]
    rows += [(10 + i, "f", f"Car number {i}: 1/5") for i in range(40)]
    for df in both_ways(spark.createDataFrame(rows, "i bigint, k string, r string")):
        found = aggregate.family_rivals(df, "k", "r", "i").first()["rivals"]
        assert [r["name"] for r in found] == [
            "MINI", "Fiat", "Car number 0", "Car number 1", "Car number 2"]


def test_family_body(spark):
    rows = [
        (1, "a", None, None), (2, "a", "Hatchback", 4200.0), (3, "a", "SUV", 4500.0),
        (4, "b", "Hatchback", None), (5, "c", "Other", 4000.0), (6, "d", "Hatchback", 4900.0),
    ]
    df = spark.createDataFrame(rows, "i bigint, k string, b string, n double")
    got = {r["k"]: r for r in aggregate.family_body(df, "k", "b", C("n"), "i").collect()}
    assert (got["a"]["rule_label"], got["a"]["median_length"]) == ("medium hatchback", 4350.0)
    assert got["b"]["rule_label"] == "medium hatchback" and got["b"]["median_length"] is None
    assert got["c"]["ambiguous"] and got["d"]["ambiguous"] and not got["a"]["ambiguous"]


@pytest.mark.parametrize("distinct", [False, True])
def test_order_statistics_with_a_hot_group(spark, distinct):
    rng = random.Random(5)
    data = [("hot", round(rng.lognormvariate(8, 2), 2)) for _ in range(4000)]
    data += [(f"g{i % 50}", float(rng.randint(-40, 40))) for i in range(2000)]
    data += [("one", 7.0), ("nan", float("nan")), ("null", None)]
    df = spark.createDataFrame(data, "k string, v double")
    got = ranks.order_statistics(
        df, ["k"], "v",
        {"first": lambda n: F.lit(1), "low": lambda n: F.floor(n / 10) + 1, "last": lambda n: n},
        distinct=distinct).collect()
    groups = {}
    for k, v in data:
        if v is not None and v == v:
            groups.setdefault(k, []).append(v)
    assert len(got) == len(groups)
    for row in got:
        values = sorted(set(groups[row["k"]]) if distinct else groups[row["k"]])
        n = len(values)
        assert tuple(row)[1:] == (n, values[0], values[n // 10], values[-1])


def test_no_window_orders_more_than_the_bound(spark):
    """A million distinct values between 0 and 1 in one group, next to a small one."""
    hot = spark.range(1_000_000).select(F.lit("hot").alias("k"), (C("id") / 1_000_003).alias("v"))
    df = hot.unionByName(spark.createDataFrame([("few", float(i)) for i in range(9)], "k string, v double"))
    wanted = {"low": lambda n: F.floor(n / 10) + 1, "last": lambda n: n}
    counted = settle(ranks.count_values(df, ["k"], "v", False), "counted")
    assert ranks.rank_cells(counted, ["k"], wanted, 5000).agg(F.max("_values")).first()[0] <= 5000
    got = {r["k"]: tuple(r)[1:] for r in ranks.order_statistics(df, ["k"], "v", wanted, bound=5000).collect()}
    assert got == {"hot": (1_000_000, 100_000 / 1_000_003, 999_999 / 1_000_003), "few": (9, 0.0, 8.0)}


def test_order_statistics_of_any_doubles(spark):
    """Values of all sizes and signs, ordered in cells of at most two."""
    rng = random.Random(8)
    data = [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randint(-300, 300) for _ in range(300)]
    data += [5e-324, -5e-324, 0.0, float("inf"), float("-inf"), 1.0, 1.0 + 2**-52, 1.0 + 2**-51, 1.0]
    df = spark.createDataFrame([("a", v) for v in data], "k string, v double")
    wanted = {f"r{i}": (lambda n, i=i: F.lit(i)) for i in (1, 2, 50, 154, 155, 156, 200, len(data))}
    got = ranks.order_statistics(df, ["k"], "v", wanted, bound=2).first()
    assert tuple(got)[2:] == tuple(sorted(data)[int(name[1:]) - 1] for name in wanted)


def test_median_matches_statistics(spark):
    rng = random.Random(6)
    data = [(f"g{i % 7}", float(rng.randint(3500, 5500))) for i in range(999)]
    df = spark.createDataFrame(data, "k string, v double")
    for row in ranks.median(df, ["k"], "v", "m").collect():
        assert row["m"] == statistics.median(v for k, v in data if k == row["k"])


def test_robust_range_small_and_large(spark):
    data = [("s", float(p)) for p in (50, 150, 150, 900)] + [("b", 100.0 + i) for i in range(25)]
    df = spark.createDataFrame(data, "k string, p double")
    got = {r["k"]: tuple(r)[1:] for r in aggregate.robust_range(df, "k", C("p")).collect()}
    assert got["s"] == (150.0, 900.0, "medium", "sample n=2")
    assert got["b"] == (102.0, 122.0, "medium", "sample n=25")


def test_column_profile(spark):
    df = spark.createDataFrame(
        [("1", "a"), ("0", ""), ("-2", None), ("nan", "a")], "n string, s string")
    got = {r["column"]: r.asDict() for r in quality.column_profile(df, ["n", "s"]).collect()}
    assert got["n"]["zeros"] == 1 and got["n"]["negatives"] == 1 and got["n"]["nan_texts"] == 1
    assert (got["n"]["min_number"], got["n"]["max_number"]) == (-2.0, 1.0)
    assert got["s"]["nulls"] == 1 and got["s"]["blanks"] == 1 and got["s"]["distinct_values"] == 2


def test_vector_profile(spark):
    df = spark.createDataFrame(
        [(1, "[1,0]"), (2, "[3,4]"), (3, "[1,x]"), (4, "[]"), (5, None)], "i bigint, v string")
    got = {r["dimension"]: r for r in quality.vector_profile(df, ["v"]).collect()}
    assert got[2]["cells"] == 2 and got[2]["off_norm"] == 1
    assert got[None]["cells"] == 2 and got[0]["off_norm"] == 1
    first = quality.vector_profile(df, ["v"], sample=1, order="i").collect()
    assert [(r["dimension"], r["cells"]) for r in first] == [(2, 1)]


def test_sampling_ignores_partitioning(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a, b = (search.sample_rows(d, "k", 20, "s").collect() for d in both_ways(df))
    assert a == b and len({r["k"] for r in a}) == 20
    assert search.sample_rows(df, "k", 5000, "s").count() == 1000
    assert search.sample_rows(df, "k", 20, "other").collect() != a


def test_row_window_and_union(spark):
    df = spark.range(10).withColumnRenamed("id", "i")
    assert [r["i"] for r in search.row_window(df, "i", 3, 2).collect()] == [3, 4]
    both = search.append_union(df, df.withColumn("x", F.lit("n")))
    assert both.count() == 20 and both.columns == ["i", "x"]
