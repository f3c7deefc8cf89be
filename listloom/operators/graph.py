"""The foreign-key graph between lists, and the web hierarchy."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import names
from ..scale import broadcast_if_small
from ..session import materialise
from .scope import base_type_name

SELF = "Self"


def build_graph_nodes(lists: DataFrame) -> DataFrame:
    return lists.select(
        F.col("guid").alias("list_guid"),
        "title",
        "web_url",
        "item_count",
        "base_type",
        base_type_name(F.col("base_type")).alias("base_type_name"),
    )


def build_graph_edges(lists: DataFrame, list_fields: DataFrame) -> DataFrame:
    """One edge per lookup column with a target; a target nobody knows is kept as dangling."""
    source = lists.select(
        F.col("guid").alias("list_guid"),
        F.col("title").alias("source_list_title"),
        F.col("web_url").alias("source_web_url"),
    )
    target = lists.select(F.col("guid").alias("target_list_guid"), F.col("title").alias("target_list_title"), F.lit(True).alias("_known"))
    wanted = list_fields.filter(
        F.col("type").isin("Lookup", "LookupMulti") & (F.coalesce(F.col("lookup_list"), F.lit("")) != "")
    )
    own = F.col("lookup_list") == SELF
    return (
        wanted.join(source, "list_guid")
        .withColumn("self_reference", own)
        .withColumn(
            "target_list_guid",
            F.when(own, F.col("list_guid")).otherwise(names.normalise_guid(F.col("lookup_list"))),
        )
        .join(target, "target_list_guid", "left")
        .select(
            F.col("list_guid").alias("source_list_guid"),
            "source_list_title",
            "source_web_url",
            "target_list_guid",
            "target_list_title",
            F.col("name").alias("field_name"),
            F.when(F.col("display_name") != "", F.col("display_name")).otherwise(F.col("name")).alias("field_display_name"),
            "show_field",
            (F.coalesce(F.col("mult"), F.lit(False)) | (F.col("type") == "LookupMulti")).alias("multi"),
            "self_reference",
            F.col("_known").isNull().alias("dangling"),
        )
    )


def graph_summary(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row of counts over nodes and edges in a single aggregate."""
    flags = ["dangling", "self_reference", "multi"]
    off = [F.lit(False).alias(f) for f in flags]
    rows = nodes.select(F.lit(True).alias("node"), *off).unionByName(edges.select(F.lit(False).alias("node"), *flags))
    return rows.agg(
        F.count_if("node").alias("lists"),
        F.count_if(~F.col("node")).alias("edges"),
        F.count_if("dangling").alias("dangling_edges"),
        F.count_if("self_reference").alias("self_references"),
        F.count_if("multi").alias("multi_value_edges"),
    )


def _anchored(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Urls with one parent, each with the nearest url above that has several or none, and how far up that is.

    Every round doubles the way that a url looks up, so rounds follow the logarithm of the depth. Urls that only a
    circle leads to never get there and are left out. Second result: the urls with several parents.
    """
    parents = pairs.groupBy("child").agg(F.count(F.lit(1)).alias("n"), F.min("parent").alias("parent"))
    counted = materialise(parents)
    joints = counted.filter("n > 1").select(F.col("child").alias("url"))
    single = counted.filter("n = 1").select(F.col("child").alias("url"), F.col("parent").alias("above"), F.lit(1).cast("bigint").alias("far"))
    total = single.count()
    reached, looking = [], single
    # ``step`` says for every url where it looks; those that have arrived stay in it.
    step = single
    for _ in range(total.bit_length() + 1):
        next_ = broadcast_if_small(step.select(F.col("url").alias("above"), F.col("above").alias("_above"), F.col("far").alias("_far")))
        moved = materialise(looking.join(next_, "above", "left").select("url", "above", "far", "_above", "_far"))
        done = moved.filter("_above IS NULL").select("url", "above", "far")
        looking = moved.filter("_above IS NOT NULL").select("url", F.col("_above").alias("above"), (F.col("far") + F.col("_far")).alias("far"))
        reached.append(done)
        if looking.isEmpty():
            break
        step = reduce(DataFrame.unionByName, reached).unionByName(looking)
    return reduce(DataFrame.unionByName, reached), joints


def _depths(pairs: DataFrame, root: str) -> DataFrame:
    """Least number of steps from the root to each url it leads to."""
    start = pairs.sparkSession.range(1).select(F.lit(root).alias("url"), F.lit(0).cast("bigint").alias("depth"))
    anchored, joints = _anchored(pairs)
    known = start
    if not joints.isEmpty():
        # Steps between urls with several parents: from the anchor of a parent, or from a parent that is one itself.
        into = pairs.join(broadcast_if_small(joints), pairs["child"] == joints["url"], "left_semi")
        far = into.join(anchored, into["parent"] == anchored["url"], "left")
        ways = far.select(F.coalesce("above", "parent").alias("a"), "child", (F.coalesce("far", F.lit(0)) + 1).alias("w"))
        ways = materialise(ways.groupBy("a", "child").agg(F.min("w").alias("w")))
        frontier = start
        while not frontier.isEmpty():
            found = ways.join(broadcast_if_small(frontier), F.col("a") == F.col("url")).groupBy("child").agg(F.min(F.col("depth") + F.col("w")).alias("depth"))
            best = known.select(F.col("url").alias("child"), F.col("depth").alias("_before"))
            better = found.join(best, "child", "left").filter("_before IS NULL OR depth < _before")
            frontier = materialise(better.select(F.col("child").alias("url"), "depth"))
            known = materialise(known.unionByName(frontier).groupBy("url").agg(F.min("depth").alias("depth")))
    tops = broadcast_if_small(known.select(F.col("url").alias("above"), F.col("depth").alias("_top")))
    return known.unionByName(anchored.join(tops, "above").select("url", (F.col("_top") + F.col("far")).alias("depth")))


def walk_hierarchy(
    edges: DataFrame, root: str, unreadable: DataFrame | None = None, max_depth: int | None = None
) -> DataFrame:
    """The webs that a breadth-first walk from parent to child urls meets; every url once, so cycles end.

    ``edges`` has ``parent``, ``child``, ``title`` and ``pos``; ``unreadable`` has
    ``url``. Without ``max_depth`` the whole tree is walked. Depths are not found level by level: a url with one parent
    looks up ever longer ways (pointer doubling), and only urls with several parents are compared in rounds of their
    own. Then one join gives the titles: of a url found with several, the one of the highest parent, lowest in
    ``parent`` and ``pos`` among equals. The result has ``url``, ``title``, ``depth`` and ``status``: ``read``,
    ``unreadable`` (subtree lost) or ``depth_limit`` (not visited further).
    """
    spark = edges.sparkSession
    lost = (unreadable.select("url") if unreadable is not None else spark.createDataFrame([], "url string")).distinct()
    if unreadable is not None and not lost.filter(F.col("url") == root).isEmpty():
        raise ValueError(f"the root {root} is unreadable")
    shut = broadcast_if_small(lost)
    open_ = edges.join(shut, edges["parent"] == shut["url"], "left_anti").select("parent", "child", "title", "pos")
    steps = open_.filter((F.col("parent") != F.col("child")) & (F.col("child") != root))
    depths = _depths(materialise(steps.select("parent", "child").distinct()), root)
    if max_depth is not None:
        depths = depths.filter(F.col("depth") <= max_depth)
    depths = materialise(depths)
    cut = F.lit(False) if max_depth is None else F.col("depth") >= max_depth
    visited = depths.filter(~cut).select(F.col("url").alias("parent"), (F.col("depth") + 1).alias("_at"))
    titled = open_.filter(F.coalesce(F.col("title"), F.lit("")) != "").join(visited, "parent")
    best = titled.groupBy(F.col("child").alias("url")).agg(F.min(F.struct("_at", "parent", "pos", "title")).alias("_b"))
    marked = depths.join(shut.withColumn("_lost", F.lit(True)), "url", "left").join(best, "url", "left")
    status = F.when(F.col("_lost"), "unreadable").when(cut & (F.col("depth") > 0), "depth_limit").otherwise("read")
    return marked.select("url", F.coalesce("_b.title", F.lit("")).alias("title"), F.col("depth").cast("int").alias("depth"), status.alias("status"))


def walk_summary(walked: DataFrame) -> DataFrame:
    """Webs found, depth reached, what was lost, and whether the walk is complete."""
    return walked.agg(
        F.count(F.lit(1)).alias("webs"),
        F.max(F.when(F.col("status") == "read", F.col("depth"))).alias("depth_reached"),
        F.count_if(F.col("status") == "unreadable").alias("unreadable"),
        F.count_if(F.col("status") == "depth_limit").alias("depth_limited"),
        F.coalesce(F.every(F.col("status") == "read"), F.lit(True)).alias("complete"),
    )
