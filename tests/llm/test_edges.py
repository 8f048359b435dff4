"""Missing values, empty and very long texts, repeated rows, empty tables and clashing columns, for every operator."""

import time

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from catalith.llm import (
    counting, licences, lines, mixing, neardup, packing, quality, sharding, topk, urls,
)
from catalith.session import shared_folder

LONG = " ".join(f"word{i % 977}x{i}" for i in range(60_000))
ROWS = [
    (1, "Some ordinary words stand here in a row of eleven words.\nA second line of it.", "en", "a", 0),
    (1, "Some ordinary words stand here in a row of eleven words.\nA second line of it.", "en", "a", 0),
    (2, None, None, None, None),
    (3, "", "en", "b", 0),
    (None, "No id has this text, and a line.\nA second line of it.", "de", "b", 5),
    (None, None, None, None, None),
    (4, LONG, "en", "c", 9),
    (5, "  \t\n\n \x0b ", "en", "c", 9),
    (6, "Released under the MIT License.", "en", None, 1),
    (7, "a | b", "en", "a", 1),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHES = [
    "size", "shard", "slot", "place", "bucket", "base", "text_crc32", "position", "gone", "lines", "left", "doc_key",
    "n_lines", "n_dropped", "id_key", "node_key", "row", "rank", "node", "digest", "part", "kept", "score", "id", "host",
]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.select("*", *[F.lit("mine").alias(c) for c in CLASHES])


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_packing(docs, none):
    found = rows(packing.pack(docs))
    assert sum(r["length"] for r in found if r["doc_id"] == 2) == 1  # the end id alone
    assert len([r for r in found if r["doc_id"] == 1 and r["start"] == 0]) >= 2
    total = next(r["doc_tokens"] for r in found if r["doc_id"] == 4)
    assert sum(r["length"] for r in found if r["doc_id"] == 4) == total > 60_000
    assert rows(packing.pack(none)) == []


def test_topk(spark):
    schema = "vec_id bigint, embedding array<float>, rank int, v string"
    data = [
        (20, [1.0, 2.0], 0, ""), (20, [1.0, 2.0], 0, ""), (1, [1.0, 1.0], 0, ""), (2, [1.0, 1.0], 0, ""), (3, None, 0, ""),
        (4, [1.0, None], 0, ""), (5, [float("nan"), 1.0], 0, ""), (6, [float("inf"), 1.0], 0, ""), (None, [1.0, 1.0], 0, ""),
        (7, [1.0], 0, ""), (8, [], 0, ""), (40, [], 0, ""), (9, [-0.01, 3.0], 0, ""), (1, [1.0, 1.0], 0, ""),
    ]
    df = spark.createDataFrame(data, schema)
    found = topk.exact_topk(df, F.col("vec_id") % 20 == 0, k=3).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in found] == [
        (20, 1, 9, 128 * 192 - 64), (20, 2, 1, 64 * 64 * 3), (20, 3, 1, 64 * 64 * 3), (40, 1, 8, 0)]
    assert topk.exact_topk(df.where("false"), F.col("vec_id") % 20 == 0).count() == 0


def test_near_classes(docs, none):
    found = neardup.near_classes(docs).select("id", "class_id").collect()
    assert len(found) == len(ROWS)
    classes = {(r.id, r.class_id) for r in found}
    assert (3, 2) in classes and (neardup.NO_ID, 2) in classes  # missing and empty texts are equal
    assert (1, 1) in classes and (5, 5) in classes
    kept = neardup.near_dedup(docs)
    assert kept.columns == docs.columns and kept.where("doc_id = 1").count() == 1
    assert neardup.near_classes(none).count() == 0 and neardup.near_dedup(none).count() == 0


def test_licences(spark, docs, none):
    templates = licences.built_in_templates(spark)
    assert [(r.doc_id, r.template) for r in licences.licence_scan(docs, templates).collect()] == [(6, "mit-line")]
    assert licences.licence_scan(none, templates).count() == 0
    assert licences.licence_scan(docs, templates.where("false")).count() == 0
    odd = spark.createDataFrame([("a", None), ("b", ""), ("c", "one"), (None, "two words")], "template string, text string")
    assert licences.licence_scan(docs, odd).count() == 0
    with pytest.raises(ValueError):
        licences.licence_scan(docs, templates, max_templates=2)


def test_mixing(docs, none):
    found = rows(mixing.assign(docs, ["doc_id"]))
    assert len(found) == len(ROWS) and {len(r["positions"]) == r["copies"] for r in found} == {True}
    mixed = mixing.mix(docs)
    assert mixed.columns[: len(docs.columns)] == docs.columns and mixed.count() == sum(r["copies"] for r in found)
    assert mixing.mix(none).count() == 0 and mixing.assign(none, ["doc_id"]).count() == 0


def test_token_counts(spark, docs, none):
    path = shared_folder(spark, "cache")
    found = rows(counting.token_counts(docs, path))
    assert len(found) == len(ROWS)
    assert [(r["n_bytes"], r["n_tokens"]) for r in found if r["doc_id"] in (2, 3)] == [(0, 0)] * 2
    before = spark.read.parquet(path).count()
    assert sorted(map(repr, rows(counting.token_counts(docs, path)))) == sorted(map(repr, found))
    assert spark.read.parquet(path).count() == before == 7  # nothing is encoded twice
    assert counting.token_counts(none, shared_folder(spark, "cache")).count() == 0


def test_line_dedup(docs, none):
    left = lines.dedup_lines(docs)
    assert left.columns[: len(docs.columns)] == docs.columns and left.columns[-2:] == ["_n_lines", "_n_dropped"]
    found = {(r["doc_id"], r["text"], r["_n_lines"], r["_n_dropped"]) for r in rows(left)}
    assert (1, ROWS[0][1], 2, 0) in found and (2, "", 1, 0) in found and (5, ROWS[7][1], 3, 0) in found
    assert (None, "No id has this text, and a line.", 2, 1) in found and (4, LONG, 1, 0) in found
    assert left.count() == len(ROWS) and lines.dedup_lines(none).count() == 0


def test_urls(spark):
    pages = spark.createDataFrame([
        (1, "http://A.Net/x?y", "z"), (1, "http://A.Net/x?y", "z"), (2, None, "z"), (3, "no scheme/x", "z"), (4, "", "z"),
        (None, "https://b.example.net/en/1#t", "z"), (5, "x://h", "z"), (6, "http://h/" + "a/" * 5000, "z"),
    ], "page_id bigint, url string, host string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (5, None)], "id bigint, bad int")
    found = sorted(map(tuple, urls.url_verdicts(pages, labels).select(
        "page_id", "host", "path", "rule", "verdict").collect()), key=repr)
    assert len(found) == 8 and (1, "a.net", "/x", "net/", "block") in found
    assert (2, "", "", None, "allow") in found and (3, "", "", None, "allow") in found
    assert (None, "b.example.net", "/en/1", "example.net/en/", "allow") in found
    assert urls.url_verdicts(pages.where("false"), labels).count() == 0
    assert urls.url_verdicts(pages, labels.where("false")).where("verdict = 'block'").count() == 2


def test_sharding(docs, none):
    placed = sharding.shard(docs, shards=3)
    assert placed.columns == [*docs.columns, "_size", "_text_crc32", "_shard", "_slot"]
    found = rows(placed)
    assert len(found) == len(ROWS)
    for k in {r["_shard"] for r in found}:
        assert sorted(r["_slot"] for r in found if r["_shard"] == k) == list(range(sum(r["_shard"] == k for r in found)))
    assert len({r["_shard"] for r in found if not r["text"]}) == 1
    assert sharding.shard(none).count() == 0


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None), (7, 0), (6, 1)], "doc_id bigint, quality int")
    model = quality.train(docs, labels)
    found = rows(quality.quality_rules(docs, model, docs.columns))
    assert len(found) == len(ROWS) and not any(r["kept"] for r in found if not r["row"]["text"])
    assert quality.train(docs, labels.where("false")) is None and quality.train(none, labels) is None
    plain = quality.quality_rules(docs, None, ["doc_id"])
    assert {r["row"]["doc_id"] for r in rows(plain) if r["kept"]} == {1, 4, None}
    assert quality.quality_rules(none, None, docs.columns).count() == 0


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages(spark, docs, none, tmp_path, name, stage):
    spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    for table in (docs, none):
        out = stage(spark, table, str(tmp_path))
        assert out.count() >= 0
        if name != "packing":
            assert out.columns == docs.columns


def test_line_dedup_of_a_million_repeated_lines(spark):
    """Two copies of one long log, and a text of repeated and own lines."""
    log = "\n".join(f"line number {i} of a log" for i in range(1_000_000))
    mixed = "\n".join(f"line number {i} of a log" if i % 2 else f"an own line, {i}" for i in range(50_000))
    df = spark.createDataFrame([(1, log), (2, log), (3, mixed), (3, mixed + "\nx")], "doc_id bigint, text string").repartition(4)
    start = time.time()
    found = {(r["doc_id"], r["n_lines"]): r for r in lines.dedup_lines(df).collect()}
    assert time.time() - start < 60  # it took hours when every line searched the whole set
    assert found[1, 1_000_000]["text"] == log and found[2, 1_000_000]["text"] == ""
    own = "\n".join(f"an own line, {i}" for i in range(0, 50_000, 2))
    assert found[3, 50_000]["text"] == own and found[3, 50_001]["text"] == own + "\nx"
    assert found[3, 50_001]["n_dropped"] == 25_000


def test_training_keeps_one_row_per_id(spark, monkeypatch):
    """A labelled id with 10,000 rows brings one of them to the driver."""
    seen = {}
    monkeypatch.setattr(quality, "fit", lambda x, y, n_fit: seen.update(rows=len(x)))
    docs = spark.range(10_200).select(
        F.when(F.col("id") < 10_000, 7).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality")).distinct()
    quality.train(docs, labels, train_rows=150)
    assert seen["rows"] == 150
