"""Joins against static tables: keys, sizes, hot keys and plans."""

import pytest
from pyspark.sql import functions as F

from mailstream.operators.lookup import hot_keys, join_isp, join_lists, lookup_table
from mailstream.operators.rollup import rollup_all_columns, sum_counts


def isp(spark, rows, kind="int", **options):
    table = spark.createDataFrame(rows, f"id {kind}, domain_name string")
    return lookup_table(table, **options)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0}])
def test_unknown_and_malformed_keys(spark, options):
    lookup = isp(spark, [(1, "one"), (2, "two")], **options)
    keys = ["1", "2", "3", "x", "", None]
    rows = spark.createDataFrame([(k,) for k in keys], "isp_id string")
    found = {r["isp_id"]: r["domain_name"] for r in join_isp(rows, lookup).collect()}
    assert found == {"1": "one", "2": "two", "3": None, "x": None, "": None, None: None}


def test_text_keys_are_compared_as_text(spark):
    lookup = isp(spark, [("01", "one")], kind="string")
    rows = spark.createDataFrame([("01",), ("1",)], "isp_id string")
    assert [r["domain_name"] for r in join_isp(rows, lookup).orderBy("isp_id").collect()] == ["one", None]


def test_two_tables_with_the_same_key_name(spark):
    lists = lookup_table(spark.createDataFrame([(1, "L")], "id int, code string"))
    rows = spark.createDataFrame([("1", "1")], "isp_id string, list_id string")
    row = join_lists(join_isp(rows, isp(spark, [(1, "one")])), lists).first()
    assert (row.domain_name, row.list_name) == ("one", "L")


def test_repeated_keys_are_refused_or_multiply(spark):
    rows = [(1, "one"), (1, "uno")]
    with pytest.raises(ValueError, match="not unique"):
        isp(spark, rows)
    lookup = isp(spark, rows, check_unique=False)
    facts = spark.createDataFrame([("1",)], "isp_id string")
    assert join_isp(facts, lookup).count() == 2


def test_small_tables_are_broadcast_and_large_ones_are_not(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.createDataFrame([("1",)], "isp_id string")
        small = join_isp(rows, isp(spark, [(1, "one")]))
        large = join_isp(rows, isp(spark, [(1, "one")], broadcast_bytes=10))
        assert "BroadcastHashJoin" in plan(small)
        assert "SortMergeJoin" in plan(large)
        assert "NestedLoop" not in plan(small) + plan(large)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_hot_keys_are_salted_and_their_table_rows_repeated(spark):
    """One key holds a third of the rows, the table is large, execution is not adaptive."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        key = F.when(F.col("id") % 3 == 0, "7").otherwise((F.col("id") % 1000).cast("string"))
        facts = spark.range(0, 60000, 1, 8).select(key.alias("isp_id"), "id")
        lookup = isp(spark, [(n, f"n{n}") for n in range(1000)], broadcast_bytes=0)
        hot = hot_keys(facts, {"isp_id": F.col("isp_id")}, 16)
        assert set(hot["isp_id"]) == {"7"} and 5 <= hot["isp_id"]["7"] <= 7

        def largest(joined):
            sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == 60000
            return max(sizes)

        salted, plain = join_isp(facts, lookup, hot), join_isp(facts, lookup)
        assert largest(plain) > 20000 and largest(salted) < 14000
        text = plan(salted)
        assert "SortMergeJoin" in text and "create_map" not in text.lower().replace("keys: [7]", "")
        rows = {r["id"]: r["domain_name"] for r in salted.collect()}
        assert rows == {r["id"]: f"n{r['isp_id']}" for r in facts.collect()}
        counted = salted._jdf.queryExecution().optimizedPlan().toString()
        assert "Generate explode" in counted
    finally:
        for name in settings:
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_no_key_is_hot(spark):
    rows = spark.range(1000).select((F.col("id") % 100).alias("k"), F.lit(None).cast("int").alias("none"))
    keys = {"k": F.col("k"), "none": F.col("none")}
    assert hot_keys(rows, keys, 16) == {"k": {}, "none": {}}
    assert hot_keys(rows.limit(0), keys, 16) == {"k": {}, "none": {}}
    assert hot_keys(rows, {}, 16) == {}


def test_hot_key_is_split_at_run_time(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        key = F.when(F.col("id") % 3 == 0, "7").otherwise((F.col("id") % 1000).cast("string"))
        facts = spark.range(0, 60000, 1, 8).select(key.alias("isp_id"), F.sha2(F.col("id").cast("string"), 256).alias("s"))
        lookup = isp(spark, [(n, f"n{n}") for n in range(1000)], broadcast_bytes=0)
        joined = join_isp(facts, lookup)
        rows = joined.collect()
        assert "skew=true" in plan(joined)
        assert len(rows) == 60000
        assert sum(r["domain_name"] == "n7" for r in rows) == 20000 + 40
    finally:
        for name in settings:
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_null_keys_form_one_group(spark):
    rows = spark.createDataFrame([(None, "a"), (None, "a"), ("x", None)], "k string, v string")
    counted = rollup_all_columns(rows)
    assert sorted((r["k"] or "", r["total_count"]) for r in counted.collect()) == [("", 2), ("x", 1)]
    merged = sum_counts(counted.drop("v"))
    assert sorted((r["k"] or "", r["total_count"]) for r in merged.collect()) == [("", 2), ("x", 1)]


def test_counting_needs_one_shuffle_after_partial_counts(spark):
    text = plan(rollup_all_columns(spark.range(10).selectExpr("id % 3 as k")))
    assert text.count("Exchange") == 1
    assert "partial_count" in text
