"""Quality rules: measures of whole texts and a calibrated n-gram classifier."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalith.llm.common import documents

BLANKS = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
CHAR_BINS = WORD_BINS = 4096
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MIX = np.uint64(0x9E3779B97F4A7C15)


class WordHash(dict):
    """64-bit hash of each word, remembered; emptied when it holds ``most`` words."""

    def __init__(self, most: int = 100_000):
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


HASHES = WordHash()


def rolled(hashes: np.ndarray, width: int) -> np.ndarray:
    """One 64-bit hash per window of ``width`` words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:n].copy()
    for k in range(1, width):
        out = (out ^ (out >> np.uint64(29))) * MIX + hashes[k: k + n]
    return out


def measures(raw: bytes, hashes: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one whole text."""
    n = len(hashes)
    points = np.count_nonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    blanks = len(raw) - len(raw.translate(None, BLANKS))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line.strip(BLANKS)]
    windows = rolled(hashes, 5)
    repeated = 0
    if len(windows) > 1:
        order = np.argsort(windows, kind="stable")
        same = windows[order][1:] == windows[order][:-1]
        if same.any():
            twice = np.zeros(len(windows), bool)
            twice[order[1:][same]] = True
            twice[order[:-1][same]] = True
            covered = np.zeros(n, bool)
            for k in range(5):
                covered[k: k + len(windows)] |= twice
            repeated = int(covered.sum())
    return n, int(points) - blanks, symbols, len(lines) - len(set(lines)), repeated


def features(raw: bytes, hashes: np.ndarray) -> np.ndarray:
    """Hashed character trigrams (of the UTF-8 bytes) and word one- and two-grams, each part of length 1."""
    out = np.zeros(CHAR_BINS + WORD_BINS, np.float32)
    data = np.frombuffer(raw.lower(), np.uint8)
    if len(data) >= 3:
        grams = data.astype(np.uint32)
        grams = (grams[:-2] << 16 | grams[1:-1] << 8 | grams[2:]) * np.uint32(2654435761) >> np.uint32(20)
        part = np.log1p(np.bincount(grams, minlength=CHAR_BINS))
        out[:CHAR_BINS] = part / np.linalg.norm(part)
    if len(hashes):
        keys = np.concatenate([hashes, rolled(hashes, 2)]) * MIX >> np.uint64(52)
        part = np.log1p(np.bincount(keys.astype(np.int64), minlength=WORD_BINS))
        out[CHAR_BINS:] = part / np.linalg.norm(part)
    return out


@dataclass
class Model:
    """Weights of the classifier and the two numbers of its calibration."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        margin = x @ self.weights + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.shift, -50, 50)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float, steps: int) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by accelerated gradient steps of a fixed, safe length.

    The last column of ``x`` is all ones.
    """
    weights = ahead = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 0
    length = 1.0 / (0.25 * float(np.einsum("ij,ij->i", x, x).max()) + ridge)
    for k in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ ahead.astype(x.dtype), -50, 50)))
        step = ahead - length * ((x.T @ (p - y).astype(x.dtype)) / len(y) + penalty * ahead)
        ahead, weights = step + k / (k + 3) * (step - weights), step
    return weights[:-1], float(weights[-1])


def fit(x: np.ndarray, y: np.ndarray, n_fit: int, ridge: float = 1e-5, steps: int = 400) -> Model | None:
    """Fit on the first ``n_fit`` rows and calibrate on the others; None without two classes.

    The last column of ``x`` is all ones.  Slices are views, so the rows are in memory once.
    """
    if len(np.unique(y[:n_fit])) < 2:
        return None
    weights, bias = fit_logistic(x[:n_fit], y[:n_fit], ridge, steps)
    slope, shift = 1.0, 0.0
    if len(np.unique(y[n_fit:])) == 2:
        margin = x[n_fit:, :-1] @ weights.astype(x.dtype) + bias
        spread = float(margin.std()) or 1.0
        pairs = np.stack([margin / spread, np.ones(len(margin))], axis=1)
        line, line_shift = fit_logistic(pairs, y[n_fit:], 1e-4, 2000)
        if line[0] > 0:
            slope, shift = float(line[0]) / spread, line_shift
    return Model(weights.astype(np.float32), bias, slope, shift)


def train(
    docs: DataFrame, labels: DataFrame, train_rows: int = 3000, id_col: str = "doc_id",
    text_col: str = "text", label_col: str = "quality",
) -> Model | None:
    """Fit on at most ``train_rows`` labelled rows, chosen by the hash of their id.

    Ids with a missing or contradicting label are left out.  A quarter of the rows is held out for
    the calibration.  The features of the sample (bounded, 32 KiB each) come to the driver.
    """
    chosen = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("low"), F.max(label_col).alias("y"))
        .where("low = y").select("id", F.col("y").cast("double").alias("y"), F.xxhash64("id").alias("rank"))
        .orderBy("rank", "id").limit(train_rows))
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(2).to_pylist():
                raw = text.encode()
                x = features(raw, HASHES.of(raw.split()))
                at = np.flatnonzero(x)
                found.append(at.astype("<u2").tobytes() + x[at].astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["rank", "y", "x"])

    # The sample has at most train_rows rows, so its broadcast has a fixed bound.  Copies under one id are one row
    # before anything is collected; each task already keeps one.
    rows = (
        texts.join(F.broadcast(chosen), "id").groupBy("id", "rank", "y").agg(F.min("text").alias("text"))
        .select("rank", "y", "text").mapInArrow(vectors, "rank bigint, y double, x binary").collect())
    rows = sorted((r.rank, r.y, bytes(r.x)) for r in rows)
    rows.sort(key=lambda r: (r[0] & 3) == 0)  # the held-out quarter last
    x = np.zeros((len(rows), CHAR_BINS + WORD_BINS + 1), np.float32)
    x[:, -1] = 1
    for i, (_, _, data) in enumerate(rows):
        n = len(data) // 6
        x[i, np.frombuffer(data, "<u2", n)] = np.frombuffer(data, "<f4", n, 2 * n)
    y, n_fit = np.array([r[1] for r in rows], np.float64), sum((r[0] & 3) != 0 for r in rows)
    del rows
    return fit(x, y, n_fit)


def quality_rules(
    docs: DataFrame, model: Model | None, keep: list[str], text_col: str = "text", threshold: float = 0.5,
    min_words: int = 10, max_repeat_percent: int = 20,
) -> DataFrame:
    """Measures, classifier score and verdict of each whole text, in Arrow batches.

    Gives ``row`` (a struct of the columns ``keep``), the measures, base_failed, score (the calibrated
    probability of good quality; missing without a model) and kept.  A text fails the base rules with
    fewer than ``min_words`` words or more than ``max_repeat_percent`` percent of them in repeated
    five-word windows; else it is kept if its score reaches ``threshold``.  Without a model the base
    rules decide alone.  A missing text has no words.  Every row is judged by itself, so repeated rows,
    ties, missing ids and clashing column names change nothing, and an empty table gives no rows.
    """
    schema = docs.select(F.struct(*keep).alias("row")).schema
    out_type = schema["row"].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, scores = [], []
            for text in batch.column(1).to_pylist():
                raw = (text or "").encode()
                hashes = HASHES.of(raw.split())
                found.append(measures(raw, hashes))
                failed = found[-1][0] < min_words or 100 * found[-1][4] > max_repeat_percent * found[-1][0]
                known = model is not None and not failed
                scores.append((failed, float(model.probability(features(raw, hashes))) if known else None))
            columns = [pa.array(c, pa.int64()) for c in zip(*found)] if found else [pa.array([], pa.int64())] * 5
            failed = pa.array([s[0] for s in scores], pa.bool_())
            score = pa.array([s[1] for s in scores], pa.float64())
            kept = pa.array([not f and (p is None or p >= threshold) for f, p in scores], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns, failed, score, kept],
                names=["row", *MEASURES, "base_failed", "score", "kept"])

    fields = ", ".join(f"{m} bigint" for m in MEASURES)
    return docs.select(F.struct(*keep).alias("row"), F.col(text_col).alias("text")).mapInArrow(
        judge, f"row {out_type}, {fields}, base_failed boolean, score double, kept boolean")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document; the classifier learns from the labels' sample."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_rules(docs, model, ["doc_id"]).select("row.doc_id", *MEASURES, "base_failed", "kept", "score")
