"""Gap filling: callbacks per family with a durable cache, and answer checks."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith import values
from catalith.functions.text import number, or_placeholder, strip, text
from catalith.operators.lookup import apply_results, worklist
from catalith.session import settle


def retrying(fn: Callable, attempts: int, wait_s: float) -> Callable:
    """The function with retries and doubling pauses; the last error is raised."""
    def call(arg):
        for attempt in range(attempts):
            try:
                return fn(arg)
            except Exception:
                if attempt + 1 == attempts:
                    raise
                time.sleep(wait_s * 2**attempt)
    return call


def call_in_batches(
    df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str, batch: int = 100,
    attempts: int = 3, wait_s: float = 1.0, partitions: int | None = None,
) -> DataFrame:
    """Run a user batch function over a DataFrame, ``batch`` rows at a time."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = retrying(fn, attempts, wait_s)
        for pdf in frames:
            for at in range(0, len(pdf), batch):
                yield call(pdf.iloc[at:at + batch])

    spread = df if partitions is None else df.repartition(partitions)
    return spread.mapInPandas(run, schema)


def isolating(fn: Callable[[pd.DataFrame], pd.DataFrame], key: str) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """The function on a batch; one that fails is halved until the row that fails it stands alone.

    That row comes back with its key and its error in ``_error``, the others with their answers.
    """
    def call(pdf: pd.DataFrame) -> pd.DataFrame:
        try:
            return fn(pdf).assign(_error=None)
        except Exception as error:  # whatever the callback raises is the answer of this row
            if len(pdf) > 1:
                half = len(pdf) // 2
                return pd.concat([call(pdf.iloc[:half]), call(pdf.iloc[half:])], ignore_index=True)
            return pd.DataFrame({key: pdf[key].to_numpy(), "_error": [f"{type(error).__name__}: {error}"]})
    return call


def read_cache(df: DataFrame, path: str, schema: str) -> DataFrame:
    """The cache table, empty when it was never written."""
    spark = df.sparkSession
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":  # anything else is a fault, not an empty table
            raise
        return spark.createDataFrame([], schema)


def enrich_families(
    df: DataFrame, key: str, order: str, inputs: Sequence[str],
    fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str, cache: str,
    missing: Column | None = None, force: bool = False, waves: int = 1, dead_letters: str | None = None, **batching,
) -> DataFrame:
    """Call ``fn`` once per family not in the cache, keep the answers, join them back.

    Answers are written to the cache table before use: what follows never calls
    again when an executor is lost, and a second run asks only for new families.
    ``force`` starts the cache anew.  With more ``waves`` the answers are saved
    in that many steps, so that a failed run loses one step at most.

    With a ``dead_letters`` path a family that fails its call costs only itself: its batch is halved until it stands
    alone, and it is written there with the error.  It is not in the cache, so the next run asks for it again.
    """
    columns = [f.strip().split(" ")[0] for f in schema.split(",")]
    todo = settle(
        worklist(df, key, order, inputs, read_cache(df, cache, schema), missing, force), "worklist"
    )
    for wave in range(waves):
        part = todo if waves == 1 else todo.where(F.pmod(F.xxhash64(key), F.lit(waves)) == wave)
        mode = "overwrite" if force and wave == 0 else "append"
        if dead_letters is None:
            call_in_batches(part, fn, schema, **batching).write.mode(mode).parquet(cache)
            continue
        retried = {k: batching[k] for k in ("attempts", "wait_s") if k in batching}
        patient = retrying(fn, retried.get("attempts", 3), retried.get("wait_s", 1.0))
        answers = settle(call_in_batches(
            part, isolating(patient, key), f"{schema}, _error string", **(batching | {"attempts": 1})), "answers")
        answers.where("_error IS NULL").drop("_error").write.mode(mode).parquet(cache)
        answers.where("_error IS NOT NULL").select(key, "_error").write.mode(mode).parquet(dead_letters)
    results = read_cache(df, cache, schema)
    # the cache is a written table already
    return apply_results(df, results, key, [c for c in columns if c != key], settled=False)


def embed_batches(
    df: DataFrame, id_col: str, source: str, fn: Callable[[list[str]], np.ndarray], dimension: int,
    batch: int = 100, id_type: str = "bigint", zero_on_error: bool = False,
    unit: bool = True, attempts: int = 3, wait_s: float = 1.0,
) -> DataFrame:
    """(id, vector) through a user function; blank text becomes the placeholder."""
    def one_batch(pdf: pd.DataFrame) -> pd.DataFrame:
        call = retrying(fn, attempts, wait_s)
        try:
            out = np.asarray(call(pdf["_text"].tolist()), dtype=np.float64)
        except Exception:
            if not zero_on_error:
                raise
            out = np.zeros((len(pdf), dimension))
        if out.shape != (len(pdf), dimension):
            raise ValueError(f"expected {(len(pdf), dimension)} values, got {out.shape}")
        if unit:
            length = np.linalg.norm(out, axis=1, keepdims=True)
            out = np.divide(out, length, out=out.copy(), where=length > 0)
        return pd.DataFrame({id_col: pdf[id_col].to_numpy(), "vector": list(out.astype("float32"))})

    prepared = df.select(id_col, or_placeholder(F.col(source)).alias("_text"))
    return call_in_batches(
        prepared, one_batch, f"{id_col} {id_type}, vector array<float>", batch, attempts=1
    )


# checks on answers ---------------------------------------------------------

def sanitize_prices(
    answer: Column, own_low: Column, own_high: Column, floor: float = values.PRICE_FLOOR,
) -> dict[str, Column]:
    """Ordered, floored price range of an answer struct; the row's own values fill gaps."""
    low, high = answer["min_used_price_gbp"], answer["max_used_price_gbp"]
    least = F.when(low.isNotNull() & high.isNotNull(), F.least(low, high)).otherwise(low)
    most = F.when(low.isNotNull() & high.isNotNull(), F.greatest(low, high)).otherwise(high)
    least = F.when(least < floor, F.lit(float(floor))).otherwise(least)
    most = F.when(most.isNotNull(), F.greatest(most, F.coalesce(least, F.lit(float(floor)))))
    confidence, notes = values.NO_ANSWER
    given = F.coalesce(F.nullif(answer["confidence"], F.lit("")), F.lit(values.DEFAULT_CONFIDENCE))
    return {
        "price_low": F.coalesce(least, number(own_low, thousands=True)),
        "price_high": F.coalesce(most, number(own_high, thousands=True)),
        "confidence": F.when(answer.isNull(), F.lit(confidence)).otherwise(given),
        "notes": F.when(answer.isNull(), F.lit(notes)).otherwise(text(answer["notes"])),
    }


def needs_fill(col: Column) -> Column:
    """Missing, blank or zero."""
    own = strip(text(col))
    return own.isin(*values.ZERO_TEXTS) | F.coalesce(number(own) == 0, F.lit(False))


def sanitize_specs(mpg: Column, insurance: Column, sprint: Column) -> dict[str, Column]:
    """Answers outside their range become NULL."""
    group = F.when(insurance >= 0, F.floor(insurance)).otherwise(F.ceil(insurance)).cast("int")
    return {
        "mpg": F.when((mpg > 0) & (mpg <= values.MPG_MAX), mpg),
        "insurance": F.when(group.between(values.INSURANCE_MIN, values.INSURANCE_MAX), group),
        "sprint": F.when((sprint > 0) & (sprint <= values.SPRINT_MAX), sprint),
    }


def fill_missing(own: Column, answer: Column, positive_only: bool = False) -> Column:
    """The answer where the own value is missing and the answer usable."""
    usable = answer.isNotNull()
    if positive_only:
        usable = usable & (answer > 0)
    return F.when(needs_fill(own) & usable, answer).otherwise(number(own))
