"""What reaches the scan, and what is shuffled."""

import pytest

import __spark_entry__ as entry
from catalith.operators import ranks

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    df = entry.queries()[name](spark, SF)
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name, columns", [
    ("norm_years", "p_partkey:bigint,p_size:int"),
    ("mileage_rule", "p_partkey:bigint"),
    ("page_markdown", "page_id:bigint,html:string"),
    ("value_counts", "p_partkey:bigint"),
    ("status_summary", "event_type:string"),
])
def test_only_needed_columns_are_read(spark, name, columns):
    assert f"ReadSchema: struct<{columns}>" in plan(spark, name)


@pytest.mark.parametrize("name, pushed", [
    ("row_window", "GreaterThanOrEqual(p_partkey,50), LessThan(p_partkey,150)"),
    ("query_vector_subquery", "EqualTo(vec_id,1)"),
])
def test_filters_reach_the_scan(spark, name, pushed):
    assert pushed in plan(spark, name)


@pytest.mark.parametrize("name", [
    "norm_ws", "size_bucket", "essence_main", "pros_cons", "page_sections", "answer_json",
    "load_strict", "specs_string_all", "sanitize_prices", "parse_rivals",
])
def test_row_work_needs_no_shuffle(spark, name):
    # pros_cons joins two tables, by broadcast at this size
    text = plan(spark, name)
    assert "Exchange hashpartitioning" not in text and "PythonUDF" not in text


def test_ranks_read_only_what_they_count(spark):
    listings = spark.read.parquet(f"{SF}/lineitem.parquet").where("l_extendedprice >= 100")
    text = ranks.count_values(listings, ["l_partkey"], "l_extendedprice", True)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_partkey:bigint,l_extendedprice:double>" in text
    assert "GreaterThanOrEqual(l_extendedprice,100.0)" in text


def test_top_k_keeps_k_rows_per_task(spark):
    assert "TakeOrderedAndProject" in plan(spark, "cosine_topk")
    assert "WindowGroupLimit" in plan(spark, "family_rivals")


def test_no_plan_has_a_cross_product(spark):
    for name in ("approx_topk", "query_vector_subquery", "page_fields", "two_stage_search"):
        text = plan(spark, name)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", [
    "essence_family", "family_first", "pick_best_string", "first_nonblank", "family_rivals",
    "family_body", "cache_last_wins", "robust_range", "cosine_topk", "sample_rows", "worklist",
])
@pytest.mark.parametrize("partitions", ["1", "13"])
def test_results_do_not_depend_on_partitions(spark, name, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    expected = sorted(map(repr, entry.queries()[name](spark, SF).collect()))
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        assert sorted(map(repr, entry.queries()[name](spark, SF).collect())) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
