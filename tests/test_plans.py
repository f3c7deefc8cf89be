"""Shapes of physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from listloom import scale
from listloom.functions import names
from listloom.operators import decode, incremental, joins, ordering, reports, scope


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"Exchange (?:hash|range|Single|RoundRobin)", plan(df)))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("stored")

    def save(df, name):
        df.write.parquet(str(root / name))
        return spark.read.parquet(str(root / name))

    raw = spark.range(200).select(
        F.concat(F.lit("{"), (F.col("id") % 3).cast("string"), F.lit("}")).alias("list_guid"), F.col("id").alias("item_id"),
        F.create_map(F.lit("ows_ID"), F.col("id").cast("string"), F.lit("ows_Title"), F.lit("x")).alias("raw"), F.lit("wide").alias("unused"),
    )
    fields = spark.createDataFrame([("{0}", 0, "Title", "Titel", "Text", None)], "list_guid string, pos int, name string, display_name string, type string, result_type string")
    lists = spark.createDataFrame([("{0}", "Zero", "http://x", "0", "", "")], "guid string, title string, web_url string, base_type string, root_folder string, default_view_url string")
    return {"raw": save(raw, "raw"), "fields": save(fields, "fields"), "lists": save(lists, "lists")}


def test_decode_and_item_records_do_not_shuffle(stored):
    decoded = decode.decode_items(stored["raw"].drop("unused"), stored["fields"])
    assert shuffles(decoded) == 0 and "BroadcastHashJoin" in plan(decoded)
    items = scope.build_items(stored["raw"], stored["lists"])
    assert shuffles(items) == 0
    assert "unused" not in plan(items)


def test_filters_reach_the_scan(stored):
    decoded = decode.decode_items(stored["raw"], stored["fields"]).filter("item_id = 7")
    assert "PushedFilters: [IsNotNull(item_id), EqualTo(item_id,7)]" in decoded._jdf.queryExecution().explainString(
        decoded.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_threads_shuffle_each_side_once(spark):
    kids = spark.range(100).select((F.col("id") % 7).alias("fk"), "id")
    parents = spark.range(7).withColumnRenamed("id", "pk")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = joins.attach_children_in_parts(parents, kids, "pk", "fk", F.col("id"), [F.col("id")], ["id"], 1000)
        assert shuffles(out) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_small_feeds_leave_the_target_in_place(spark):
    target = spark.range(1000).select(F.lit("{A}").alias("list_guid"), F.col("id").alias("item_id"), F.lit("t").alias("title"))
    feed = spark.range(10).select(F.lit("{A}").alias("list_guid"), F.col("id").alias("item_id"), F.lit("Update").alias("change_type"), F.lit("n").alias("title"), F.col("id").alias("seq"))
    out = incremental.apply_latest(target, incremental.latest_per_key(feed))
    assert shuffles(out) == 0 and out.count() == 1000


def test_counting_happens_before_joining(stored):
    text = plan(reports.landing_stats(stored["lists"], stored["raw"], stored["raw"].select("list_guid", F.lit(1).alias("bytes"))))
    assert text.count("partial_count") >= 2 and "Cartesian" not in text and "NestedLoop" not in text


def test_names_stay_in_the_jvm(spark):
    df = spark.range(1).select(names.file_name_from_url(F.lit("http://x/a")).alias("n"))
    assert "Python" not in plan(df)


def test_pick_keeps_the_first_rows_of_a_kind_before_the_shuffle(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("kind"), F.col("id"))
    plan = ordering.stratified_pick(rows, "kind", "id", 20)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_dates_are_verified_without_shuffling_fields(spark):
    fields = spark.createDataFrame([("{A}", 1, "Created", "DateTime", None, "2020-01-01T00:00:00Z")], "list_guid string, item_id bigint, field string, wire_type string, result_type string, raw string")
    named = spark.createDataFrame([("{A}", "Created", "Erstellt")], "list_guid string, name string, display_name string")
    lists = spark.createDataFrame([("{A}", "http://sp/a", "0", "", "")], "guid string, web_url string, base_type string, root_folder string, default_view_url string")
    out = decode.verify_datetimes(decode.decode_fields(fields), named, lists)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    row = out.first()
    assert (row["display_name"], row["decoded_utc"], row["display_url"]) == ("Erstellt", "2020-01-01T00:00:00Z", "http://sp/a/DispForm.aspx?ID=1")


def test_large_keys_are_ranked_with_one_shuffle_of_their_rows(spark):
    rows = spark.range(3000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"), F.lit("x" * 20).alias("wide"))
    ranked = scale._rank_by_range(rows, ["k"], [F.desc("v")], "r")
    shown = plan(ranked)
    assert "Window" not in shown and "SortMergeJoin" not in shown and "Exchange hashpartitioning" not in shown
    got = {(r["k"], r["v"]): r["r"] for r in ranked.collect()}
    assert got == {(v % 2, v): (2999 - v) // 2 + 1 for v in range(3000)}
