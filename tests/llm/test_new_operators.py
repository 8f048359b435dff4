"""Jaccard join, whitening and alignment against plain versions, and on odd input."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalith.llm import alignment, jaccard, mixing, whitening
from tests.llm.test_edges import ROWS, SCHEMA

CLASHES = ["node", "root", "sign", "id", "copy", "same", "n", "x", "component", "chunk", "pair", "place", "total", "home"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).select("*", *[F.lit("mine").alias(c) for c in CLASHES])


# ---- Jaccard join

def shingle_set(text):
    words = WORD.findall((text or "").translate(LOWER))
    width = min(5, len(words))
    return frozenset(tuple(words[i: i + width]) for i in range(len(words) - width + 1)) if words else frozenset()


def classes(texts):
    """Component of every id, by comparing all pairs."""
    sets, root = {i: shingle_set(t) for i, t in texts.items()}, {i: i for i in texts}
    ids = sorted(texts)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def families(seed, n=40):
    """Texts in families whose members lie around the similarity, with a passage that all families share."""
    draw = random.Random(seed)
    word = lambda: f"w{draw.randrange(4000)}"
    passage, out = [word() for _ in range(40)], {}
    for _ in range(n):
        base = [word() for _ in range(draw.choice([1, 3, 5, 6, 9, 13, 20, 45, 90, 200]))]
        if draw.random() < 0.4:
            base = base + passage
        for _ in range(draw.choice([1, 2, 3, 6, 12])):
            text = list(base)
            for _ in range(draw.randrange(1 + len(text) // 25 + draw.randrange(3))):
                text[draw.randrange(len(text))] = word()
            if draw.random() < 0.3:
                text = text[draw.randrange(1 + len(text) // 12):]
            out[len(out) + 1] = " ".join(text)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_join_equals_all_pairs(spark, seed):
    texts = families(seed)
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(5)
    found = {r["id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_classes(df).collect()}
    assert found == classes(texts)


def test_large_mixed_buckets(spark):
    """Many texts that are mostly one passage meet in the same buckets, but only some of them link."""
    draw = random.Random(5)
    passage = [f"p{i}" for i in range(60)]
    texts = {i: " ".join(passage + [f"x{i % 30}y{k}" for k in range(6 + draw.randrange(14))]) for i in range(1, 121)}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    found = {r["id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_classes(df).collect()}
    assert found == classes(texts)


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(3)
    for _ in range(400):
        size = int(rng.integers(4, 260))
        pool = rng.integers(0, 2**64, 2 * size, dtype=np.uint64)
        a = pool[:size]
        drop = int(rng.integers(0, 1 + size // 9))
        add = int(rng.integers(0, 1 + size // 9))
        b = np.concatenate([a[drop:], pool[size: size + add]])
        common = size - drop
        if 5 * common < 4 * (len(a) + len(b) - common) or not drop + add:
            continue
        number, high = max(jaccard.band(len(a)), jaccard.band(len(b)))
        one, two = jaccard.signatures([np.unique(a), np.unique(b)], high, number)
        assert np.isin(one, two).any()


def test_jaccard_odd_input(docs):
    found = sorted(
        ((r["id"], r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_classes(docs).collect()),
        key=lambda r: (r[0] is None, r))
    assert found[:2] == [(1, 12, 1)] * 2  # repeated rows are one document
    assert (2, 0, 2) in found and (3, 0, 3) in found and (5, 0, 5) in found  # no words: linked with nothing
    assert next(r for r in found if r[0] == 4)[2] == 4  # a very long text
    assert (None, 9, None) in found and (None, 0, None) in found
    assert jaccard.jaccard_classes(docs.where("false")).collect() == []


def test_jaccard_rows_without_id_link_others(spark):
    base = [f"a{i}" for i in range(60)]
    rows = [(7, " ".join(base)), (None, " ".join([*base[:-1], "z"])), (9, " ".join([*base[:-2], "y", "z"])), (7, "other words"), (3, "Other  WORDS")]
    found = jaccard.jaccard_classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["component_id"] for r in found} == {3}


def test_jaccard_lower_cases_ascii_only_and_not_in_spark(spark, monkeypatch):
    """Texts meet whatever the case of A to Z, other letters keep theirs; no plan lower-cases row by row."""
    plans, settle = [], jaccard.settle

    def watched(df, purpose):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return settle(df, purpose)

    monkeypatch.setattr(jaccard, "settle", watched)
    rows = [
        (5, "One TWO three Four five six"), (3, "one two THREE four five six"), (8, "ONE two three four\x0bfive\n six"),
        (1, "one two three four five s\u0131x"), (9, "\u00c4pfel und Birnen"), (4, "\u00e4pfel und birnen"),
        (2, "\u00c4PFEL UND BIRNEN"), (5, "ONE TWO THREE FOUR FIVE SIX"), (6, "\u212aelvin a b"), (7, "kelvin A B"),
    ]
    found = jaccard.jaccard_classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(map(tuple, found)) == [
        (1, 2, 1), (2, 1, 2), (3, 2, 3), (4, 1, 4), (5, 2, 3), (5, 2, 3), (6, 1, 6), (7, 1, 7), (8, 2, 3), (9, 1, 2)]
    assert plans and not any("translate(" in p for p in plans)


def test_sieve_keeps_all_that_is_wanted(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "node")
    wanted = rows.where("node % 100 = 7")
    left = {r.node for r in jaccard._sieve(rows, ["node"], wanted).collect()}
    assert {r.node for r in wanted.collect()} <= left and len(left) < 20_000 * 0.08
    assert jaccard._sieve(rows, ["node"], wanted.where("false")).count() == 0


def test_sets_without_partner_are_not_signed(spark, monkeypatch):
    """Texts that share more than half of a passage: a part of the domain does not tell that none has a partner."""
    signed, settle = [], jaccard.settle

    def watched(df, purpose):
        out = settle(df, purpose)
        if purpose == "signed-sets":
            signed.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "settle", watched)
    passage = [f"p{i}" for i in range(60)]
    texts = {i: " ".join(passage + [f"x{i}y{k}" for k in range(30)]) for i in range(1, 41)}
    texts |= {50: "a " * 9 + "b c d e f g h i j k l m n o p q r s t u v w x y z", 51: "a " * 9 + "b c d e f g h i j k l m n o p q r s t u v w x y zz"}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    found = {r["id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_classes(df).collect()}
    assert found == classes(texts) and found[51][1] == 50 and signed[0] <= 6  # all 42 before


# ---- mixing

def test_mixing_counts_what_the_mix_takes(spark, monkeypatch, tmp_path):
    """The query's words come from the mix in training order: without its second half, about half of them stay."""
    rows = [(i % 390, "w " * (1 + i % 7), ["a", "b", "c", None][i % 4]) for i in range(800)]
    rows += [(None, "one two", "a"), (None, "one two", "a"), (900, None, "b"), (901, "", None)]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    whole = mixing.op5_mixing(spark, str(tmp_path)).collect()
    assert len(whole) == len(rows) and sum(r.doc_id is None for r in whole) == 2
    assert abs(sum(r.taken for r in whole) - sum(r["size"] for r in whole)) < 20
    assert all((r.taken > 0) <= (r.first_position is not None) and r.taken <= 3 * r["size"] for r in whole)
    positions = mixing._positions
    monkeypatch.setattr(mixing, "_positions", lambda demand: F.filter(positions(demand), lambda at: at < 0.5))
    half = mixing.op5_mixing(spark, str(tmp_path)).collect()
    assert len(half) == len(rows)
    assert abs(2 * sum(r.taken for r in half) - sum(r.taken for r in whole)) < 0.05 * sum(r.taken for r in whole)


# ---- whitening

@pytest.mark.parametrize("spectrum", [
    np.ones(20), 10.0 ** -np.arange(20.0), np.repeat([5.0, 3.0, 1.0], 7), np.r_[np.ones(4), np.zeros(9)], np.linspace(1, 2, 40), np.ones(1)])
def test_components_equal_a_dense_solver(spectrum):
    rng = np.random.default_rng(0)
    turn = np.linalg.qr(rng.standard_normal((len(spectrum), len(spectrum))))[0]
    v = (turn * spectrum) @ turn.T
    v = (v + v.T) / 2
    values, vectors = whitening.components(v, 16)
    expected = np.sort(spectrum[spectrum > 1e-11 * spectrum.sum()])[::-1][:16]
    assert len(values) == len(expected)
    assert np.abs(values / expected - 1).max() < 1e-4
    assert np.abs(values - expected).max() < 1e-13 * expected[0]
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-13
    assert np.abs(v @ vectors.T - vectors.T * values).max() < 1e-12


def test_inertia_counts():
    rng = np.random.default_rng(4)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    a[:, 5] = a[5, :] = 0
    values, counted = np.linalg.eigvalsh(a), whitening.Inertia(a)
    for at in [*np.linspace(values[0] - 1, values[-1] + 1, 50)]:
        assert counted.above(at) == (values > at).sum()


def test_whitening_contract(spark):
    rng = np.random.default_rng(7)
    data = (rng.standard_normal((300, 24)) * np.linspace(0.2, 3, 24) + 1).astype(np.float32)
    rows = [(i, x.tolist()) for i, x in enumerate(data)] + [(900 + i, data[0].tolist()) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = whitening.whitened(df).toPandas()
    x = np.floor(64 * data.astype(float)).astype(int) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = fit - s / n
    values = np.sort(np.linalg.eigvalsh(centred.T @ centred / n))[::-1]
    assert len(found) == 500 * 16 and set(found["n"]) == {n}
    by_id = found.drop_duplicates("vec_id").set_index("vec_id")["deviation"]
    assert all(by_id[i] == ((n * x[i] - s) ** 2).sum() for i in range(300))
    shares = found.drop_duplicates("component").sort_values("component")["explained"].to_numpy()
    assert np.abs(shares / (values[:16] / values.sum()) - 1).max() < 1e-9
    wide = found[found["vec_id"] < 300].pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.abs(np.cov(wide.T, bias=True) - np.eye(16)).max() < 1e-9
    assert found["identity_error"].nunique() == 1 and found["identity_error"].iloc[0] < 1e-9


def test_whitening_odd_input(spark):
    schema = "vec_id bigint, embedding array<float>, x string, n int, component string"
    ok = [(1, [1.0, 2.0, 0.5], "", 0, ""), (1, [1.0, 2.0, 0.5], "", 0, ""), (None, [3.0, 1.0, 0.5], "", 0, ""), (4, [0.0, 5.0, 0.5], "", 0, "")]
    odd = [
        (5, None, "", 0, ""), (6, [], "", 0, ""), (7, [1.0, None, 2.0], "", 0, ""), (8, [float("nan"), 1.0, 1.0], "", 0, ""),
        (9, [float("inf"), 1.0, 1.0], "", 0, ""), (10, [1e30, 1.0, 1.0], "", 0, ""), (11, [1.0, 2.0], "", 0, "")]
    df = spark.createDataFrame(ok + odd, schema)
    found = whitening.whitened(df).collect()
    assert Counter(r["vec_id"] for r in found) == {1: 4, None: 2, 4: 2}  # three points span two directions
    assert {r["n"] for r in found} == {3}
    assert whitening.whitened(df.where("vec_id = 1")).collect() == []  # one distinct vector: no variance
    assert whitening.whitened(df.where("vec_id = 5")).collect() == []
    assert whitening.whitened(df.where("false")).columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_products_are_exact_beyond_doubles(spark):
    """Sums that no double holds: far apart values and a long column of them."""
    rows = [(i, [float(2**40 + 3 * i), float(-(2**38) + i * i)]) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    points = df.select(whitening.scaled(F.col("embedding")).alias("x"))
    made = whitening.fit(points)
    x = [[64 * int(c) + 1_000_000 for c in v] for _, v in rows]
    n, s = 50, [sum(c) for c in zip(*x)]
    v = [[sum((n * r[i] - s[i]) * (n * r[j] - s[j]) for r in x) / n**3 for j in range(2)] for i in range(2)]
    assert made.sums == s
    assert made.trace == pytest.approx(v[0][0] + v[1][1], rel=1e-12)


# ---- alignment

def plain_alignment(texts):
    """Each text's (n_a, n_b, groups as text, links), by comparing byte ranges one by one."""
    a, b = alignment.vocabulary("byte_bpe_50k.json"), alignment.vocabulary("piece_bpe_32k.model")
    out = []
    for text in texts:
        if not text:
            out.append(None)
            continue
        spans = []
        for side in (a, b):
            at, own = 0, []
            for i in side.encode([text])[0]:
                own.append((at, at + len(side.pieces[i]), i))
                at += len(side.pieces[i])
            spans.append(own if b"".join(side.pieces[i] for *_, i in own) == b" " + text.encode() else None)
        if None in spans:
            out.append(None)
            continue
        left, right = spans
        links = [(i, j) for s, e, i in left for t, f, j in right if s < f and t < e]
        cuts = sorted({e for _, e, _ in left} & {e for _, e, _ in right})
        groups = ";".join(
            "|".join(",".join(str(i) for _, e, i in side if x < e <= y) for side in spans) for x, y in zip([0, *cuts], cuts))
        out.append((len(left), len(right), groups, links))
    return out


TEXTS = [
    "Plain words, and some more of them.", "  two blanks first", "trailing blanks  ", "a  b   c", "line\nbreaks \n and\n\n tabs\t\there ",
    "<|endoftext|> and <s> stand in the text</s>", "naïve café 東京 🙂 é", "it's we'll I'M 123 45678 !?… ", " ", "\n", " x  y", "", None,
    "under▁score", "x" * 300, "blank before newline \nnext", "a \n \nb", "Plain words, and some more of them.", "\x1c a \x1c b", "<0x41> is no byte",
]


def test_alignment_equals_byte_ranges(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string").repartition(4)
    docs, pairs = alignment.aligned(df, chunk_bytes=150, remember=20)
    plain = plain_alignment(TEXTS)
    counts = Counter(link for p in plain if p for link in p[3])
    most = defaultdict(int)
    for (_, j), c in counts.items():
        most[j] = max(most[j], c)
    for r in docs.collect():
        p = plain[r["doc_id"]]
        expected = (0, 0, 0, 0, 0, 0, "") if p is None else (
            p[0], p[1], p[2].count(";") + 1, len(p[3]), sum(counts[x] == most[x[1]] for x in p[3]), sum(counts[x] for x in p[3]),
            hashlib.sha256(p[2].encode()).hexdigest())
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) == expected, TEXTS[r["doc_id"]]
    assert {(r["a_id"], r["b_id"]): r["links"] for r in pairs.collect()} == counts
    assert all(r["best"] == (r["links"] == most[r["b_id"]]) for r in pairs.collect())


def test_segments_equal_whole_texts():
    """Texts made of awkward pieces, aligned by segments and as a whole."""
    draw = random.Random(11)
    pieces = [" ", "  ", "\n", "\t", "a", "word", "Ünï", "12", "!", "'s", " ", " ", "東", "<s>", "\x1c", "\r\n", "x.y", "▁"]
    texts = ["".join(draw.choice(pieces) for _ in range(draw.randrange(1, 14))) for _ in range(400)]
    memory = alignment.Segments("byte_bpe_50k.json", "piece_bpe_32k.model", 10_000)
    for text, found, plain in zip(texts, memory.of(texts), plain_alignment(texts)):
        if None in found:
            assert plain is None, text
            continue
        raw, written, n_a, n_b, n_groups = zip(*found)
        links = Counter(divmod(int(p), 1 << alignment.B_BITS) for p in np.frombuffer(b"".join(raw), "<i8"))
        assert (sum(n_a), sum(n_b), ";".join(written), links) == (plain[0], plain[1], plain[2], Counter(plain[3])), text


def test_alignment_odd_input(docs):
    found = alignment.aligned(docs)[0].collect()
    assert len(found) == len(ROWS)
    long = next(r for r in found if r["doc_id"] == 4)
    assert long["n_a"] > 60_000 and long["n_links"] >= max(long["n_a"], long["n_b"])
    for r in found:
        if r["doc_id"] in (2, 3):
            assert (r["n_a"], r["n_groups"], r["groups_sha256"]) == (0, 0, "")
    assert alignment.aligned(docs.where("false"))[0].collect() == []
