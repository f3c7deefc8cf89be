"""Captured pages and change feeds as streams."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.incremental import KEY, apply_latest, latest_per_key
from ..scale import broadcast_if_small
from ..session import materialise
from ..sinks.landing import current_version, prune_versions, publish_snapshot, published_version, read_snapshot
from ..sources import captured


# A backlog is read in about so many batches at most, since each batch has a cost of its own of a second or two.
BACKLOG_BATCHES = 20


def _files_a_batch(spark: SparkSession, path: str, per_batch: int) -> int:
    """``per_batch`` files, or more where what has been captured would take more than ``BACKLOG_BATCHES`` batches."""
    try:
        files = len(spark.read.format("text").load(path).inputFiles())
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        files = 0
    return max(per_batch, -(-files // BACKLOG_BATCHES))


def _xml_stream(spark: SparkSession, path: str, row_tag: str, schema, per_batch: int | None) -> DataFrame:
    reader = (
        spark.readStream.format("xml")
        .option("rowTag", row_tag)
        .option("ignoreSurroundingSpaces", "false")
        .schema(schema)
    )
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", _files_a_batch(spark, path, per_batch))
    return reader.load(path)


def stream_pages(spark: SparkSession, path: str, columns: Sequence[str], per_batch: int | None = None) -> DataFrame:
    """Item pages as they arrive; the query's checkpoint is the resume point.

    A batch has ``per_batch`` files, and more of a long backlog: its batches do not follow its length.
    """
    stream = _xml_stream(spark, path, "rs:data", captured.rowset_schema(columns), per_batch)
    return captured.page_rows(captured.rowset_pages(stream, columns))


def stream_change_pages(
    spark: SparkSession, path: str, columns: Sequence[str], list_guid: Column, per_batch: int | None = None
) -> DataFrame:
    """Change pages as they arrive, with the list they belong to; batches as in ``stream_pages``."""
    stream = _xml_stream(spark, path, "listitems", captured.change_schema(columns), per_batch)
    return captured.change_pages(stream, columns).withColumn("list_guid", list_guid)


def page_stream(
    pages: DataFrame, landing: str, checkpoint: str, shape: Callable[[DataFrame], DataFrame] = lambda d: d
) -> StreamingQuery:
    """Load pages batch by batch; a batch replayed after a kill overwrites its own part."""

    def load(batch: DataFrame, batch_id: int) -> None:
        shape(batch).write.mode("overwrite").parquet(f"{landing}/batch_id={batch_id}")

    return (
        pages.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def change_stream(
    pages: DataFrame, table: str, checkpoint: str, shape: Callable[[DataFrame], DataFrame] = lambda d: d
) -> StreamingQuery:
    """Append each batch of change pages, reduced to the last change per key and page, to the change log.

    A page with an invalid token ends its list: that page and later ones, of this batch or
    any other one, are left out until the list has been reloaded (``lists_to_reload``,
    ``note_reload`` after ``compact``), in whatever order the pages came. A batch owns its directory, so a replay replaces it and the base
    is not rewritten per batch. What a batch needs besides its pages is the table of stopped lists, which only batches
    with a refused token rewrite and which is read again only then, so its cost does not follow the number of batches run. ``current_rows`` reads base and log,
    ``compact`` folds the log in and deletes it. ``shape`` turns change rows into the columns of the table. Table and
    checkpoint belong together.
    """
    stops = _StopsOfRun(table)

    def load(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            spark = batch.sparkSession
            # One job over all pages, which also fills the cache; a search for the first one would run page by page.
            if batch.agg(F.max("token_invalid")).first()[0]:
                refused = batch.filter("token_invalid")
                _note_stops(spark, table, refused.groupBy("list_guid").agg(F.min(captured.page_key()).alias("stop")), batch_id)
            known = stops.upto(spark, batch_id)
            good = batch
            if known is not None:
                joined = batch.join(known, "list_guid", "left")
                good = joined.filter(F.col("stop").isNull() | (captured.page_key() < F.col("stop"))).drop("stop")
            rows = shape(captured.change_rows(good, F.col("list_guid")))
            _last_of_page(rows).write.mode("overwrite").parquet(f"{table}/changes/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return (
        pages.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def _last_of_page(rows: DataFrame) -> DataFrame:
    """The last change per key and page; rows whose ``seq`` names no page are kept."""
    seq = rows.schema["seq"].dataType
    if not isinstance(seq, T.StructType) or "page" not in seq.names:
        return rows
    return latest_per_key(rows.withColumn("_page", F.col("seq.page")), [*KEY, "_page"]).drop("_page")


def _before_stops(spark: SparkSession, table: str, log: DataFrame) -> DataFrame:
    """Logged changes of pages in front of the refused page of their list."""
    seq = log.schema["seq"].dataType
    known = _stopped(spark, table)
    if known is None or not isinstance(seq, T.StructType) or "page" not in seq.names:
        return log
    joined = log.join(broadcast_if_small(known.select("list_guid", "stop")), "list_guid", "left")
    return joined.filter(F.col("stop").isNull() | (F.col("seq.page") < F.col("stop"))).drop("stop")


_STOPS = "list_guid string, stop struct<page_no:bigint,path:string>, batch_id int"


def _stops_table(table: str) -> str:
    return f"{table}/stops"


def _stops(spark: SparkSession, table: str) -> DataFrame | None:
    """Refused pages that no reload has settled: a row for each list and batch; ``None`` before the first one."""
    if current_version(spark, _stops_table(table)) is None:
        return None
    return read_snapshot(spark, _stops_table(table))


def _publish_stops(spark: SparkSession, table: str, stops: DataFrame) -> None:
    # Stored first: the rows come from the version before, which is pruned.
    publish_snapshot(materialise(stops), _stops_table(table))
    prune_versions(spark, _stops_table(table))


def _note_stops(spark: SparkSession, table: str, found: DataFrame, batch_id: int) -> None:
    """Add the stops of a batch; a replay of the batch replaces its own."""
    rows = found.select("list_guid", "stop", F.lit(batch_id).alias("batch_id"))
    before = _stops(spark, table)
    _publish_stops(spark, table, rows if before is None else before.filter(F.col("batch_id") != batch_id).unionByName(rows))


def lists_to_reload(spark: SparkSession, table: str, after_batch: int = -1) -> DataFrame:
    """Lists whose token was refused, with the last batch that says so.

    Lists noted as reloaded are left out. Pass the batch of the previous reload as ``after_batch`` to
    see only what came since.
    """
    known = _stopped(spark, table)
    if known is None:
        known = spark.createDataFrame([], _STOPS)
    return known.filter(F.col("batch_id") > after_batch).select("list_guid", "batch_id")


def note_reload(spark: SparkSession, table: str, reloaded: DataFrame) -> None:
    """Note lists that were read in full again: ``list_guid`` and the ``batch_id`` of ``lists_to_reload``."""
    stops = _stops(spark, table)
    if stops is None:
        return
    done = broadcast_if_small(reloaded.groupBy("list_guid").agg(F.max("batch_id").alias("_done")))
    left = stops.join(done, "list_guid", "left").filter(F.col("_done").isNull() | (F.col("batch_id") > F.col("_done")))
    _publish_stops(spark, table, left.drop("_done"))


def _stopped(spark: SparkSession, table: str, last_batch: int | None = None) -> DataFrame | None:
    """Lists that are stopped: their first refused page since the last reload, and the last batch that says so."""
    stops = _stops(spark, table)
    if stops is None:
        return None
    if last_batch is not None:
        stops = stops.filter(F.col("batch_id") <= last_batch)
    return stops.groupBy("list_guid").agg(F.min("stop").alias("stop"), F.max("batch_id").alias("batch_id"))


class _StopsOfRun:
    """Where each stopped list ends, for one batch of a run after the other; read again only where a version has been published since."""

    def __init__(self, table: str) -> None:
        self.table = table
        self.version: int | None = None
        self.known: DataFrame | None = None

    def upto(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """``list_guid`` and ``stop`` as of ``batch_id``, hinted for the join with the pages."""
        version = published_version(spark, _stops_table(self.table))
        if version is None or version == self.version:
            return self.known if version else None
        known = _stopped(spark, self.table, batch_id)
        # Stored, since the version it comes from may be pruned.
        self.known = broadcast_if_small(materialise(known.select("list_guid", "stop")))
        # A stop of a later batch counts from that one on; with one, what holds now is not kept.
        last = _stops(spark, self.table).agg(F.max("batch_id")).first()[0]
        self.version = version if last is None or last <= batch_id else None
        return self.known


def _folded(spark: SparkSession, table: str) -> int:
    """The last batch that the published base contains."""
    last = current_version(spark, table)
    return -1 if last is None or last["batch_id"] is None else last["batch_id"]


def _applied_table(table: str) -> str:
    return f"{table}/applied"


def _pending(spark: SparkSession, table: str, keys: Sequence[str]) -> DataFrame | None:
    """The last change of each key that the base does not have yet.

    A change that arrives after one of a later page was folded in is dropped: ``applied`` keeps the place of the last
    change of every key, of deleted ones too. A change of that very place is applied again, with the same result.
    """
    log = _log(spark, table)
    if log is None:
        return None
    last = latest_per_key(_before_stops(spark, table, log.filter(F.col("batch_id") > _folded(spark, table))), keys)
    if current_version(spark, _applied_table(table)) is None:
        return last
    done = read_snapshot(spark, _applied_table(table)).select(*keys, F.col("seq").alias("_applied"))
    joined = last.join(done, list(keys), "left")
    return joined.filter(F.col("_applied").isNull() | (F.col("seq") >= F.col("_applied"))).drop("_applied")


def current_rows(spark: SparkSession, table: str, keys: Sequence[str] = KEY) -> DataFrame:
    """The table with all logged changes applied, the last one per key by feed order.

    ``seq`` orders the whole feed, so pages may arrive in any order, before and after ``compact``.
    """
    base = read_snapshot(spark, table)
    pending = _pending(spark, table, keys)
    return base if pending is None else apply_latest(base, pending, keys)


def compact(spark: SparkSession, table: str, keys: Sequence[str] = KEY) -> int:
    """Publish base plus log as the new base, then delete the folded batches and old versions.

    The places of the changes are published before the base: whatever a crash leaves, a second call ends with the same table.
    """
    log = _log(spark, table)
    top = None if log is None else log.agg(F.max("batch_id")).first()[0]
    pending = _pending(spark, table, keys)
    if pending is not None:
        places = pending.select(*keys, "seq")
        if current_version(spark, _applied_table(table)) is not None:
            places = latest_per_key(read_snapshot(spark, _applied_table(table)).unionByName(places), keys)
        publish_snapshot(places, _applied_table(table))
    # Of an empty log the base keeps the batch it had.
    version = publish_snapshot(current_rows(spark, table, keys), table, _folded(spark, table) if top is None else top)
    _drop_batches(spark, table, _folded(spark, table))
    for versioned in (table, _applied_table(table)):
        prune_versions(spark, versioned)
    return version


def _batches(spark: SparkSession, table: str) -> dict[int, object]:
    """Folders of the change log by batch."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{table}/changes/batch_id=*")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {int(f.getPath().getName().partition("=")[2]): f.getPath() for f in fs.globStatus(folder) or []}


def _log(spark: SparkSession, table: str) -> DataFrame | None:
    """The change log, ``None`` where all batches are folded in or none has come."""
    return spark.read.parquet(f"{table}/changes") if _batches(spark, table) else None


def _drop_batches(spark: SparkSession, table: str, upto: int) -> None:
    """Delete the folders of batches that the base contains."""
    for batch, path in _batches(spark, table).items():
        if batch <= upto:
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def live_threads(children: DataFrame, event_time: str, keys: Sequence[str], delay: str) -> DataFrame:
    """Children for a live view: re-sent rows are dropped within the allowed lateness."""
    return children.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def live_children(
    parents: DataFrame, children: DataFrame, pk: str, fk: str, parent_time: str, child_time: str, delay: str, before: str, within: str
) -> DataFrame:
    """Each parent with every child of its own, as both arrive: a row per child, one with NULLs for a parent without any.

    A child counts from ``before`` ahead of its parent's time to ``within`` after it. Either may come first: both wait in
    state until the watermarks say that no partner can come any more, so rows later than ``delay`` are left out and state
    does not grow with the stream. A childless parent comes out when its time is over. The rows are those of the batch
    join over the same condition.
    """
    left = parents.withWatermark(parent_time, delay).alias("p")
    right = children.withWatermark(child_time, delay).alias("c")
    at, born = F.col(f"c.{child_time}"), F.col(f"p.{parent_time}")
    near = (at >= born - F.expr(f"INTERVAL {before}")) & (at <= born + F.expr(f"INTERVAL {within}"))
    return left.join(right, (F.col(f"p.{pk}") == F.col(f"c.{fk}")) & near, "left_outer")
