"""Hot keys, parts and size checks: the split paths give what the plain ones give."""

from pyspark.sql import functions as F

from listloom import scale
from listloom.operators import joins, ordering


def skewed(spark, n=3000):
    """A third of the rows share one key, another share has no key at all."""
    k = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.col("id") % 50)
    return spark.range(n).select(k.cast("bigint").alias("k"), ((F.col("id") * 7919) % 1009).alias("v"), "id")


def test_rank_of_hot_keys_equals_plain_rank(spark):
    df = skewed(spark)
    order = [F.col("v").asc_nulls_first(), F.col("id")]
    plain = {r["id"]: r["rank"] for r in scale.rank_within(df, ["k"], order).collect()}
    split = {r["id"]: r["rank"] for r in scale.rank_within(df, ["k"], order, hot_rows=100).collect()}
    assert plain == split and len(split) == 3000


def test_rank_with_equal_order_values(spark):
    """All rows of the hot key tie on the first order column."""
    df = spark.range(2000).select(F.lit(1).alias("k"), F.lit(None).cast("int").alias("v"), "id")
    out = scale.rank_within(df, ["k"], [F.col("v").asc_nulls_first(), F.col("id")], hot_rows=10)
    assert out.filter(F.col("rank") != F.col("id") + 1).count() == 0 and out.count() == 2000


def test_global_index(spark):
    out = scale.global_index(skewed(spark).repartition(7), [F.col("id").desc()])
    assert out.filter(F.col("idx") != 2999 - F.col("id")).count() == 0


def test_long_threads_continue_in_parts(spark):
    parents = spark.createDataFrame([(0,), (1,), (99,)], "pk bigint")
    children = skewed(spark)
    args = (parents, children, "pk", "k", F.col("v"), [F.col("id")], ["id"])
    whole = joins.attach_children_in_parts(*args, 1_000_000)
    parts = joins.attach_children_in_parts(*args, 64, hot_rows=100)
    assert [r["part"] for r in whole.filter("pk = 0").collect()] == [0]
    rows = parts.filter("pk = 0").orderBy("part").collect()
    glued = [c["id"] for r in rows for c in r["comments"]]
    assert glued == [c["id"] for c in whole.filter("pk = 0").first()["comments"]] and len(glued) > 1000
    assert len(rows) == -(-len(glued) // 64) and max(len(r["comments"]) for r in rows) == 64
    assert parts.filter("pk = 99").first()["comments"] == []


def test_broadcast_only_below_the_bounds(spark):
    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().logical().toString().lower()

    df = spark.range(100)
    assert hinted(scale.broadcast_if_small(df))
    assert not hinted(scale.broadcast_if_small(df, rows=99))
    assert not hinted(scale.broadcast_if_small(df, size=100))


def test_unique_names_against_brute_force(spark):
    names = ["a.txt", "a.txt", "a(1).txt", "a.txt", "b", "b", "a(3).txt", "a.txt", "a(1).txt", "c.d", "a(01).txt"]
    rows = [(i % 2, i, n) for i, n in enumerate(names * 6)]
    files = spark.createDataFrame(rows, "item int, pos int, name string")
    for hot in (10**6, 3):
        out = ordering.unique_file_names(files, "item", "name", "pos", hot_rows=hot).collect()
        assert len(out) == len(rows)
        got = {(r["item"], r["unique_name"]) for r in out}
        assert len(got) == len(rows)
        originals = {(i, n) for i, _p, n in rows}
        assert originals <= got
    one = spark.createDataFrame([(1, p, n) for p, n in enumerate(["a.txt", "a(1).txt", "a.txt", "a.txt", "x", "x"])], "item int, pos int, name string")
    got = {r["pos"]: r["unique_name"] for r in ordering.unique_file_names(one, "item", "name", "pos").collect()}
    assert got == {0: "a.txt", 1: "a(1).txt", 2: "a(2).txt", 3: "a(3).txt", 4: "x", 5: "x(1)"}


def test_paging_of_one_hot_list(spark):
    items = spark.range(1005).select(F.lit("{L}").alias("list_guid"), (F.col("id") * 3).alias("item_id"))
    paged = ordering.assign_pages(items, ["list_guid"], [F.col("item_id")], 100, hot_rows=50)
    pages = ordering.page_progress(paged, ["list_guid"], "item_id").orderBy("page_no").collect()
    assert [p["rows"] for p in pages] == [100] * 10 + [5]
    assert pages[-1]["written"] == 1005 and pages[0]["checkpoint_id"] == 297
    assert ordering.limit_new_rows(paged, 250, 100).count() == 300


def test_stalled_pages(spark):
    pages = spark.createDataFrame([("a", 1, 10), ("a", 2, 10), ("a", 3, 30), ("b", 1, 5), ("b", 2, 9), ("c", 1, None)], "list_guid string, page_no bigint, max_id bigint")
    stalls = {r["list_guid"]: r["stalled_page"] for r in ordering.find_stalled_pages(pages, ["list_guid"]).collect()}
    assert stalls == {"a": 2, "c": 1}
    kept = {(r["list_guid"], r["page_no"]) for r in ordering.accepted_pages(pages, ["list_guid"]).collect()}
    assert kept == {("a", 1), ("b", 1), ("b", 2)}
    assert ordering.accepted_pages(pages, ["list_guid"], keep_stalled=True).count() == 5


def test_samples(spark):
    ids = spark.range(10).select("id")
    assert [r["id"] for r in ordering.spread_sample(ids, [F.col("id")], 4).orderBy("id").collect()] == [0, 2, 4, 6]
    assert ordering.spread_sample(ids, [F.col("id")], 50).count() == 10
    files = spark.createDataFrame([(0, "x"), (1, "x"), (2, "y"), (3, "x"), (4, "z")], "pos int, kind string")
    assert [r["pos"] for r in ordering.stratified_pick(files, "kind", "pos", 4).collect()] == [0, 2, 4, 1]
