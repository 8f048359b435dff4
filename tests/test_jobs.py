"""Sources, sinks, enrichment and incremental runs."""

import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from catalith.operators import enrich, search
from catalith.sources import documents, loading, tables
from catalith.streaming import incremental

C = F.col


def test_quoted_csv_file(spark, tmp_path):
    df = spark.createDataFrame([("a", 'say "x"'), (None, "l1\nl2")], "p string, q string")
    tables.write_quoted_csv(df.coalesce(1), str(tmp_path / "o"))
    text = next((tmp_path / "o").glob("*.csv")).read_text()
    assert text == '"p","q"\n"a","say ""x"""\n"","l1\nl2"\n'


def test_vectors_sink_csv_and_json(spark, tmp_path):
    df = spark.createDataFrame([("r", [0.5, 1.0])], "row_id string, v array<float>")
    for fmt in ("json", "csv"):
        path = str(tmp_path / fmt)
        tables.write_vectors(df, path, ["v"], fmt)
        tables.write_vectors(df, path, ["v"], fmt)
        back = spark.read.json(path) if fmt == "json" else spark.read.option(
            "header", True).option("escape", '"').csv(path)
        assert [r["v"] for r in back.collect()] == ["[0.5,1.0]"] * 2


def test_required_columns_fail_early(spark):
    with pytest.raises(ValueError, match="model"):
        tables.rename(spark.createDataFrame([("a",)], "Make string"), required=["make", "model"])


def test_cache_lines_last_wins(spark, tmp_path):
    (tmp_path / "c.jsonl").write_text(
        '{"fid": "a", "data": {"k": 1}}\n{bad\n{"fid": "a", "data": {"k": 2}}\n{"fid": "b"}\n')
    lines = tables.read_cache_lines(spark, str(tmp_path / "c.jsonl"))
    got = tables.cache_last_wins(lines, "line", "line_no", "k bigint").collect()
    assert [(r["fid"], r["data"]["k"]) for r in got] == [("a", 2)]


def refresh_rows(spark):
    rows = [
        (1, "1", "[1,2]", '[{"name": "a", "extra": {"k": [1, 2]}}]'), (2, "x", "[1,2]", "[]"), (3, "", "", ""),
        (4, "2", "[1,z]", "{bad"), (5, "99999999999", "[]", None)]
    return spark.createDataFrame(rows, "i int, n string, v_text string, j string")


def test_full_refresh_keeps_rejects_apart(spark, tmp_path):
    path, df = str(tmp_path), refresh_rows(spark)
    assert loading.write_full_refresh(loading.full_refresh(df, ["v_text"], ["n"], "j"), path) == 1
    loaded, rejected = loading.read_full_refresh(spark, path)
    good = {r["i"]: r for r in loaded.withColumn("j", F.to_json("j")).collect()}
    assert set(good) == {1, 3} and (good[1]["n"], good[1]["v"]) == (1, [1.0, 2.0])
    assert json.loads(good[1]["j"]) == [{"name": "a", "extra": {"k": [1, 2]}}]  # unknown keys survive
    bad = {r["i"]: r for r in rejected.collect()}
    assert {i: r["reasons"] for i, r in bad.items()} == {
        2: ["n: not a number"], 4: ["j: not JSON", "v_text: not a vector"], 5: ["n: not a number"]}
    assert (bad[4]["n"], bad[4]["v_text"], bad[4]["j"], bad[5]["n"]) == ("2", "[1,z]", "{bad", "99999999999")


def test_full_refresh_computes_rows_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = refresh_rows(spark)
    counted = df.mapInArrow(count, df.schema)
    loading.write_full_refresh(loading.full_refresh(counted, ["v_text"], ["n"], "j"), str(tmp_path))
    assert seen.value == 5


def test_failed_refresh_leaves_the_old_version(spark, tmp_path):
    path, df = str(tmp_path), refresh_rows(spark)
    loading.write_full_refresh(loading.full_refresh(df.where("i = 1"), ["v_text"], ["n"], "j"), path)
    broken = loading.full_refresh(df.withColumn("i", F.raise_error(F.lit("lost")).cast("int")), ["v_text"], ["n"], "j")
    with pytest.raises(Exception, match="lost"):
        loading.write_full_refresh(broken, path)
    assert loading.versions(spark, path) == [1]
    assert [r["i"] for r in loading.read_full_refresh(spark, path)[0].collect()] == [1]
    for i in (2, 3, 4):
        assert loading.write_full_refresh(loading.full_refresh(df.where(F.col("i") == i), ["v_text"], ["n"], "j"), path) == i
    assert loading.versions(spark, path) == [3, 4]
    assert [r["i"] for r in loading.read_full_refresh(spark, path)[1].collect()] == [4]


def test_strict_load_rejects_numbers_out_of_range(spark):
    df = refresh_rows(spark).withColumn("v_text", F.lit("[1]"))
    assert [r["i"] for r in loading.load_strict(df, ["v_text"], ["n"]).orderBy("i").collect()] == [1, 3, 4]


def test_documents_without_success_keep_only_json(spark):
    doc = '{"processing_status": "failed", "title": "t", "url": "u"}'
    df = spark.createDataFrame([(1, doc, "u", "s")], "i bigint, d string, u string, s string")
    flat = documents.flatten(df, "d", ["i"]).first()
    assert (flat["title"], flat["full_json"], flat["processing_status"]) == ("", doc, "failed")
    assert len(flat) == 23
    assert documents.essential(df, "d", "u", "s").first()["processing_status"] == "failed"
    stub = df.select(documents.unresolved(C("u"), F.lit("gone")).alias("x")).first()["x"]
    assert stub == '{"url":"u","processing_status":"failed","error":"gone"}'


def counting(path):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        with open(path, "a") as log:
            log.write("".join(f"{k}\n" for k in pdf["k"]))
        return pd.DataFrame({"k": pdf["k"], "out": pdf["v"].str.upper()})
    return fn


def test_enrichment_calls_each_family_once(spark, tmp_path):
    log, cache = str(tmp_path / "calls"), str(tmp_path / "cache")
    df = spark.createDataFrame([(i, f"f{i % 5}", f"v{i % 5}") for i in range(40)],
                               "i bigint, k string, v string")
    args = ("k", "i", ["v"], counting(log), "k string, out string", cache)
    first = enrich.enrich_families(df.where("i % 5 < 3"), *args)
    assert first.where(C("out") == F.upper("v")).count() == 24
    second = enrich.enrich_families(df, *args)
    assert second.count() == 40 and second.where(C("out").isNull()).count() == 0
    calls = open(log).read().split()
    assert sorted(calls) == ["f0", "f1", "f2", "f3", "f4"]
    enrich.enrich_families(df, *args, force=True, waves=3)
    assert len(open(log).read().split()) == 10
    assert spark.read.parquet(cache).count() == 5


def test_retries_then_raises():
    seen = []

    def flaky(x):
        seen.append(x)
        if len(seen) < 3:
            raise OSError("busy")
        return x
    assert enrich.retrying(flaky, 3, 0.0)(1) == 1
    with pytest.raises(OSError):
        enrich.retrying(lambda x: (_ for _ in ()).throw(OSError()), 2, 0.0)(1)


def test_embedding_checks(spark):
    df = spark.createDataFrame([(1, "abc"), (2, ""), (3, None)], "i bigint, t string")
    got = enrich.embed_batches(
        df, "i", "t", lambda ts: np.array([[len(t), 0.0] for t in ts]), 2, unit=False).collect()
    assert {r["i"]: r["vector"][0] for r in got} == {1: 3.0, 2: 11.0, 3: 11.0}

    def broken(_texts):
        raise OSError("down")
    zero = enrich.embed_batches(df, "i", "t", broken, 2, zero_on_error=True, attempts=1)
    assert {tuple(r["vector"]) for r in zero.collect()} == {(0.0, 0.0)}
    with pytest.raises(Exception, match="expected"):
        enrich.embed_batches(df, "i", "t", lambda ts: np.zeros((len(ts), 3)), 2).collect()


def test_needs_fill_and_fill(one):
    for given in ("0", "0.0", "", None, "0.00", " "):
        assert one(enrich.needs_fill(C("s")), s=given) is True
    assert one(enrich.needs_fill(C("s")), s="12") is False
    assert one(enrich.fill_missing(C("s"), F.lit(5.0)), s="0") == 5.0
    assert one(enrich.fill_missing(C("s"), F.lit(5.0)), s="7") == 7.0
    assert one(enrich.fill_missing(C("s"), F.lit(-1.0), positive_only=True), s="0") == 0.0


def test_resume_is_idempotent_and_skips_seen_keys(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))

    def arrive(name, ids):
        rows = spark.createDataFrame([(i, name) for i in ids], "k bigint, batch string")
        rows.coalesce(1).write.parquet(f"{src}/{name}")

    def run():
        incremental.resume(spark, f"{src}/*", "k bigint, batch string", out, state, "k")
        return {r["k"]: r["batch"] for r in spark.read.parquet(out).collect()}

    arrive("a", range(10))
    assert run() == {k: "a" for k in range(10)}
    assert run() == {k: "a" for k in range(10)}
    arrive("b", range(5, 15))
    expected = {k: "a" if k < 10 else "b" for k in range(15)}
    assert run() == expected
    assert spark.read.parquet(out).count() == 15
    # a batch that is run again after a failure leaves the same rows
    again = spark.createDataFrame([(k, "b") for k in range(5, 15)], "k bigint, batch string")
    incremental.append_batch(again, 1, out, "k")
    assert spark.read.parquet(out).count() == 15


def test_batch_reads_only_the_buckets_of_its_keys(spark, tmp_path):
    """Other buckets hold no readable file; a batch whose keys are elsewhere never opens them."""
    out = str(tmp_path / "out")
    rows = spark.range(200).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    incremental.append_batch(rows, 0, out, "k", buckets=16)
    mine = rows.where(incremental.bucket(F.col("k"), 16) == 3)
    for folder in (tmp_path / "out-keys" / "batch_id=0").glob("bucket=*"):
        if folder.name != "bucket=3":
            for file in folder.glob("*.parquet"):
                file.write_bytes(b"no parquet")
    fresh = spark.range(1000, 1400).select(F.col("id").alias("k"), F.lit("y").alias("v")).where(
        incremental.bucket(F.col("k"), 16) == 3)
    incremental.append_batch(mine.unionByName(fresh), 1, out, "k", buckets=16)
    got = spark.read.parquet(f"{out}/batch_id=1")
    assert got.count() == fresh.count() > 0 and {r["v"] for r in got.collect()} == {"y"}


def test_resume_transforms_only_new_rows(spark, tmp_path):
    log, out = tmp_path / "seen", str(tmp_path / "out")
    rows = spark.createDataFrame([(k, f"t{k}") for k in range(6)], "k bigint, t string")

    def embed(texts):
        with open(log, "a") as f:
            f.write("".join(f"{t}\n" for t in texts))
        return np.ones((len(texts), 2))

    def transform(df):
        return enrich.embed_batches(df, "k", "t", embed, 2)

    incremental.append_batch(rows.where("k < 4"), 0, out, "k", transform)
    incremental.append_batch(rows, 1, out, "k", transform)
    assert sorted(open(log).read().split()) == [f"t{k}" for k in range(6)]
    assert spark.read.parquet(out).count() == 6


def test_price_gaps_falls_back_to_both_own_prices(spark):
    from catalith.plans import jobs

    cars = spark.createDataFrame(
        [(1, "a", None, "9,000"), (2, "b", "100", "200")], "car_id int, fid string, low string, high string")
    listings = spark.createDataFrame([], "fid string, price double")
    got = {r.car_id: r for r in jobs.price_gaps(cars, "fid", "car_id", listings, "low", "high").collect()}
    assert (got[1].price_low_filled, got[1].price_high_filled) == (None, 9000.0)
    assert (got[2].price_low_filled, got[2].price_high_filled) == (100.0, 200.0)


def test_a_failing_family_costs_one_row(spark, tmp_path):
    """One bad family of 1,000: all others are answered, it is written with its error and asked for again."""
    def answer(pdf):
        if (pdf["k"] == 617).any() and not (tmp_path / "mended").exists():
            raise ValueError("617 is bad")
        return pd.DataFrame({"k": pdf["k"], "out": pdf["k"] * 2})

    df = spark.range(3000).select((F.col("id") % 1000).alias("k"), "id")
    dead, how = str(tmp_path / "dead"), dict(batch=100, attempts=2, wait_s=0.0, partitions=4)
    args = (df, "k", "id", ["id"], answer, "k bigint, out bigint", str(tmp_path / "cache"))
    first = enrich.enrich_families(*args, dead_letters=dead, **how)
    assert {r["k"] for r in first.where("out IS NULL").collect()} == {617} and first.count() == 3000
    assert [tuple(r) for r in spark.read.parquet(dead).collect()] == [(617, "ValueError: 617 is bad")]
    asked = tmp_path / "asked"

    def again(pdf):
        with open(asked, "a") as log:
            log.write("".join(f"{k}\n" for k in pdf["k"]))
        return answer(pdf)

    (tmp_path / "mended").touch()
    second = enrich.enrich_families(*args[:4], again, *args[5:], dead_letters=dead, **how)
    assert second.where("out IS NULL").count() == 0
    assert asked.read_text().split() == ["617"]


def test_positions_of_a_table_without_index(spark, tmp_path):
    """Several files, read in small blocks and in whole files: the same positions, and no row is moved to one task."""
    path = str(tmp_path / "csv")
    spark.range(0, 30_000, 1, 3).select("id", F.md5(F.col("id").cast("string")).alias("v")).write.csv(path, header=True)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("200000", "134217728"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = search.numbered(spark.read.csv(path, header=True))
            assert rows.where("id <> row_idx").count() == 0 and rows.count() == 30_000
            assert "SinglePartition" not in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
