"""What must not grow with the input: batches of a backlog, documents of one task, passes over a run."""

import gzip
import json
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from listloom.functions import names, wire
from listloom.operators import decode, scope
from listloom.plans import capturing
from listloom.plans.registry import Tables
from listloom.sinks import contract
from listloom.sinks import landing as sink
from listloom.sources import captured
from listloom.sources import landing as source
from listloom.streaming import feeds

CHANGE = '<listitems><Changes LastChangeToken="1;3;{n}" MoreChanges="TRUE">{gone}</Changes><rs:data ItemCount="1"><z:row ows_ID="{n}" ows_Title="t{n}"/></rs:data></listitems>'


def shape(rows):
    return rows.select("list_guid", "item_id", "change_type", F.try_element_at("raw", F.lit("ows_Title")).alias("title"), "seq")


def captured_pages(folder, body, n=7):
    folder.mkdir()
    for i in range(1, n + 1):
        (folder / f"p{i}.xml").write_text(body(i), encoding="utf-8")
    return str(folder)


def batches(folder):
    return len(list(folder.glob("batch_id=*")))


@pytest.mark.parametrize("refused", [None, 5])
def test_long_backlogs_of_changes_take_few_batches(spark, tmp_path, monkeypatch, refused):
    monkeypatch.setattr(feeds, "BACKLOG_BATCHES", 2)
    table = str(tmp_path / "table")
    sink.publish_snapshot(spark.createDataFrame([("{A}", 0, "zero")], "list_guid string, item_id bigint, title string"), table)
    path = captured_pages(tmp_path / "pages", lambda i: CHANGE.format(n=i, gone='<Id ChangeType="InvalidToken"/>' if i == refused else ""))
    pages = feeds.stream_change_pages(spark, path, ["ID", "Title"], F.lit("{A}"), 1)
    feeds.change_stream(pages, table, str(tmp_path / "progress"), shape).awaitTermination()
    assert batches(tmp_path / "table" / "changes") == 2
    rows = {(r["item_id"], r["title"]) for r in feeds.current_rows(spark, table).collect()}
    assert rows == {(0, "zero")} | {(i, f"t{i}") for i in range(1, refused or 8)}


def test_long_backlogs_of_pages_take_few_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(feeds, "BACKLOG_BATCHES", 2)
    path = captured_pages(tmp_path / "pages", lambda i: f'<rs:data ItemCount="1"><z:row ows_ID="{i}"/></rs:data>')
    out = tmp_path / "out"
    feeds.page_stream(feeds.stream_pages(spark, path, ["ID"], 1), str(out), str(tmp_path / "progress")).awaitTermination()
    assert batches(out) == 2
    assert sorted(r["item_id"] for r in spark.read.parquet(str(out)).collect()) == list(range(1, 8))


def test_short_backlogs_keep_their_batches(spark, tmp_path):
    path = captured_pages(tmp_path / "pages", lambda i: f'<rs:data ItemCount="1"><z:row ows_ID="{i}"/></rs:data>', 3)
    out = tmp_path / "out"
    feeds.page_stream(feeds.stream_pages(spark, path, ["ID"], 1), str(out), str(tmp_path / "progress")).awaitTermination()
    assert batches(out) == 3
    assert feeds._files_a_batch(spark, str(tmp_path / "absent"), 4) == 4


def test_stops_are_read_once_a_version(spark, tmp_path, monkeypatch):
    """A refused page in the first of seven batches: the others use what the first one read."""
    table, read, stopped = str(tmp_path / "table"), [], feeds._stopped
    sink.publish_snapshot(spark.createDataFrame([("{A}", 0, "zero")], "list_guid string, item_id bigint, title string"), table)
    monkeypatch.setattr(feeds, "_stopped", lambda *a: read.append(a) or stopped(*a))
    path = captured_pages(tmp_path / "pages", lambda i: CHANGE.format(n=i, gone='<Id ChangeType="InvalidToken"/>' if i == 1 else ""))
    pages = feeds.stream_change_pages(spark, path, ["ID", "Title"], F.when(F.col("page_no") % 2 == 1, "{A}").otherwise("{B}"), 1)
    feeds.change_stream(pages, table, str(tmp_path / "progress"), shape).awaitTermination()
    assert batches(tmp_path / "table" / "changes") == 7 and len(read) == 1
    assert sorted(r["item_id"] for r in feeds.current_rows(spark, table).collect()) == [0, 2, 4, 6]


def test_stops_of_a_run_follow_every_version(spark, tmp_path):
    """A reload noted during a run counts from the next batch on, and a stop of a later batch from that batch on."""
    table, stops = str(tmp_path / "table"), feeds._StopsOfRun(str(tmp_path / "table"))
    page = "struct<page_no:bigint,path:string>"

    def note(guid, batch):
        feeds._note_stops(spark, table, spark.createDataFrame([(guid, (1, "p"))], f"list_guid string, stop {page}"), batch)

    def known(batch):
        df = stops.upto(spark, batch)
        return None if df is None else {r["list_guid"] for r in df.collect()}

    assert known(0) is None and sink.published_version(spark, f"{table}/stops") is None
    note("{A}", 1)
    assert known(1) == {"{A}"} == known(2)
    (tmp_path / "table" / "stops" / "_versions" / "version=99").mkdir()
    assert sink.published_version(spark, f"{table}/stops") == 1
    feeds.note_reload(spark, table, feeds.lists_to_reload(spark, table))
    assert known(3) == set()
    note("{B}", 5)
    assert known(4) == set() and known(5) == {"{B}"} == known(6)


def test_a_backlog_takes_twenty_batches_at_most(spark, tmp_path):
    path = captured_pages(tmp_path / "pages", lambda i: f'<rs:data ItemCount="1"><z:row ows_ID="{i}"/></rs:data>', 150)
    assert feeds._files_a_batch(spark, path, 4) == 8 and feeds._files_a_batch(spark, path, 9) == 9


def test_page_stream_of_a_backlog_has_its_rows_in_few_batches(spark, tmp_path):
    path = captured_pages(tmp_path / "pages", lambda i: f'<rs:data ItemCount="1"><z:row ows_ID="{i}"/></rs:data>', 45)
    out = tmp_path / "out"
    feeds.page_stream(feeds.stream_pages(spark, path, ["ID"], 1), str(out), str(tmp_path / "progress")).awaitTermination()
    assert batches(out) == 15
    assert sorted(r["item_id"] for r in spark.read.parquet(str(out)).collect()) == list(range(1, 46))


def test_schema_fields_are_grouped_in_many_tasks(spark, tmp_path, monkeypatch):
    spark.range(50).selectExpr("id AS c_custkey", "'n' AS c_name", "id AS c_nationkey").write.parquet(str(tmp_path / "customer.parquet"))
    spark.range(2).selectExpr("id AS n_nationkey", "'n' AS n_name").write.parquet(str(tmp_path / "nation.parquet"))
    seen = []
    monkeypatch.setattr(capturing, "_save", lambda df, *_more: seen.append(df))
    capturing._schema_files(Tables(spark, str(tmp_path)))
    assert re.search(r"RepartitionByExpression \[list_guid#\d+\], 200", seen[0]._jdf.queryExecution().analyzed().toString())
    assert "SortMergeJoin" in seen[0]._jdf.queryExecution().executedPlan().toString()
    assert seen[0].count() == 52


def test_captured_documents_are_dealt_to_many_tasks(spark, tmp_path, monkeypatch):
    """Equal texts look small to Spark when they are shuffled; in the task that writes them they are not."""
    path = str(tmp_path / "docs")
    monkeypatch.setattr(capturing, "scratch_path", lambda _spark, _name: path)
    capturing._save(spark.range(400).select("id"), F.col("id") / 10, F.lit("<e/>"), "docs")
    tasks = {re.match(r"part-(\d+)", p.name)[1] for p in (tmp_path / "docs").rglob("part-*.txt")}
    assert len(list((tmp_path / "docs").glob("file=*"))) == 40 and len(tasks) > 20
    assert sum(p.read_text().count("<e/>") for p in (tmp_path / "docs").rglob("part-*.txt")) == 400


@pytest.fixture
def small(spark, tmp_path):
    o = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate string, o_orderpriority string"
    orders = spark.createDataFrame([(i, 1 + i % 2, "O", 1.5, "2020-01-02", "1-URGENT") for i in range(1, 41)], o)
    orders.withColumn("o_orderdate", F.to_date("o_orderdate")).write.parquet(str(tmp_path / "orders.parquet"))
    c = "c_custkey bigint, c_name string, c_mktsegment string, c_nationkey int"
    spark.createDataFrame([(1, "eins", "BUILDING", 0), (2, "zwei", "MACHINERY", 1)], c).write.parquet(str(tmp_path / "customer.parquet"))
    return Tables(spark, str(tmp_path))


def test_a_run_is_derived_once(small):
    """Every output of a run reads the stored items, none derives them anew."""
    records, decoded, _fields, _lists, _all, files = capturing._run(small)
    for df in (records, decoded, files):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "concat(Order " not in plan
    assert records.count() == 39 and records.select("item_id").distinct().count() == 39
    # By number, so that partitions which compress well are not put together.
    assert re.search(r"RepartitionByExpression \[list_guid#\d+, item_id#\d+L\], \d+", decoded._jdf.queryExecution().optimizedPlan().toString())


def test_landing_lines_are_compressed(spark, small, tmp_path):
    root = capturing._landing(small)
    for part in ("items", "items_raw", "attachments"):
        files = [p.name for p in Path(root.removeprefix("file:"), part).rglob("part-*")]
        assert files and all(n.endswith(".txt.gz") for n in files)
    assert source.read_items(spark, root).count() == source.read_raw_items(spark, root).count() == 39


def test_feed_dates_without_offset_cast_no_empty_text(spark):
    values = [("/Date(1000)/",), ("/Date(1000+0100)/",), ("/Date(1000-0030)/",), ("1970-01-01",), ("",), (None,)]
    df = spark.createDataFrame(values, "v string").select(F.unix_seconds(wire.feed_instant(F.col("v"))).alias("s"))
    assert [r["s"] for r in df.collect()] == [1, -3599, 1801, 0, None, None]
    # The casts of an offset stand behind a test that there is one.
    assert re.search(r"CASE WHEN NOT \(regexp_extract\([^()]*btrim", df._jdf.queryExecution().analyzed().toString())


def test_atom_members_are_joined_without_arrays(spark, tmp_path):
    folder = tmp_path / "a"
    folder.mkdir()
    entry = '<entry><content><m:properties><d:Id m:type="Edm.Int32">1</d:Id><d:Ok m:type="Edm.Boolean"> TRUE </d:Ok><d:No m:null="True"/></m:properties></content></entry>'
    (folder / "p.xml").write_text(f"<feed>{entry}<entry><content/></entry></feed>", encoding="utf-8")
    rows = captured.read_odata_atom(spark, str(folder), ["Id", "Ok", "No", "Absent"])
    assert sorted(r["j"] for r in rows.select(F.to_json("row").alias("j")).collect()) == ['{"Id":1,"No":null,"Ok":true}', "{}"]
    assert "concat_ws" in rows._jdf.queryExecution().analyzed().toString()


def contract_rows(spark, ids):
    text = F.lit(None).cast("string")
    return ids.repartition(1).sortWithinPartitions("id").select(
        F.lit("webs/w/lists/l").alias("folder"), F.lit("items.jsonl").alias("file"), text.alias("section"),
        F.format_string('{"item_id":%d,"pad":"%s"}', "id", F.lit("x" * 100)).alias("body"), F.format_string('{"ID":"%d"}', "id").alias("twin"),
    )


def test_long_lists_go_on_in_compressed_parts(spark, tmp_path):
    spark.dataSource.register(contract.ContractSource)
    root = str(tmp_path / "c")

    def write(ids, mode):
        contract_rows(spark, ids).write.format("contract_landing").mode(mode).option("plainBytes", "50000").save(root)

    def lines(name):
        parts = sorted((tmp_path / "c" / "webs" / "w" / "lists" / "l" / name).glob("part-*"))
        return [p.name for p in parts], [[json.loads(x) for x in (gzip.open(p, "rt") if p.suffix else p.open())] for p in parts]

    write(spark.range(3000), "overwrite")
    names, items = lines("items.jsonl")
    assert names == ["part-00000000", "part-00000001.gz"] == lines("items_raw.jsonl")[0]
    assert [x["item_id"] for part in items for x in part] == list(range(3000))
    # Part by part, both files hold the same items.
    assert [[x["item_id"] for x in part] for part in items] == [[int(x["ID"]) for x in part] for part in lines("items_raw.jsonl")[1]]
    write(spark.range(3000, 3003), "append")
    names, items = lines("items.jsonl")
    assert names[2:] == ["part-00000002"] and [x["item_id"] for x in items[2]] == [3000, 3001, 3002]
    assert source.read_contract_items(spark, root).agg(F.count_distinct("item_id")).first()[0] == 3003 == source.read_contract_raw_items(spark, root).count()
    # A short list is the plain file of the contract.
    write(spark.range(3), "overwrite")
    assert (tmp_path / "c" / "webs" / "w" / "lists" / "l" / "items.jsonl").read_text().count("\n") == 3


def test_lines_of_the_contract_are_derived_once(spark, small):
    """Ranges are drawn from stored lines; items, fields and files meet where they were dealt."""
    kept = capturing._kept(small)
    records, decoded, fields, _, lists, files = capturing._outputs(*kept)
    records, files = (df.repartition(kept[-1], *capturing.KEYS) for df in (records, files))
    items = sink.contract_items(records, decoded, fields)
    whole = contract.with_attachments(items, files)
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 3 and not re.search(r"hashpartitioning\(item_id", plan)
    ranged = contract._lines(items, lists, files)
    assert not re.search("Join|Generate", ranged._jdf.queryExecution().optimizedPlan().toString())
    assert ranged.filter("body IS NOT NULL").count() == 39


def test_files_are_tied_by_item_or_by_document(spark):
    items = spark.createDataFrame([("d1", "{A}", 1), ("d2", "{A}", 2)], "doc_id string, list_guid string, item_id bigint")
    extra = {"local_path": F.lit(None).cast("string"), "bytes": F.lit(3).cast("bigint"), "sha256": F.lit(None).cast("string"), "downloaded": F.lit(True), "skip_reason": F.lit(None).cast("string")}
    files = spark.createDataFrame([("d2", "{A}", 2, "u2", "b"), ("d2", "{A}", 2, "u1", "a")], "doc_id string, list_guid string, item_id bigint, url string, filename string").withColumns(extra)
    for some in (files, files.drop("item_id")):
        whole = contract.with_attachments(items, some)
        assert whole.columns == ["doc_id", "list_guid", "item_id", "attachments"]
        assert {r["doc_id"]: [f["url"] for f in r["attachments"]] for r in whole.collect()} == {"d1": [], "d2": ["u1", "u2"]}


def test_slugs_are_made_once_for_each_web(spark, monkeypatch):
    urls = ["http://farm/sites/Ä b", "http://other/x", None, "http://FARM/sites/%C3%84/?q"]
    rows = spark.createDataFrame([(u, "{AB}" if u else None) for u in urls], "web_url string, list_guid string")
    lists = spark.createDataFrame([(urls[0], "{AB}"), (urls[0], "{C}"), (None, "{D}"), (urls[3], "{E}")], "web_url string, guid string")
    own = rows.select("web_url", "list_guid", names.web_slug(F.col("web_url")).alias("web_slug"), names.guid_slug(F.col("list_guid")).alias("list_slug"))

    def seen(df):
        return sorted(map(str, df.select("web_url", "list_guid", "web_slug", "list_slug").collect()))

    placed = scope.add_slugs(rows, lists)
    assert seen(placed) == seen(own) and "BroadcastHashJoin" in placed._jdf.queryExecution().executedPlan().toString()
    # Webs that are too many to broadcast leave each row to itself.
    monkeypatch.setattr(scope, "broadcast_if_small", lambda df: df)
    assert seen(scope.add_slugs(rows, lists)) == seen(own)


def test_fields_sent_twice_keep_the_greatest_text(spark):
    raw = [("{A}", 1, {"ows_Title": "b", "ows_N": "1.50", "ows_Gone": None}), ("{A}", 1, {"ows_Title": "a", "ows_N": "", "ows_Gone": "x"}), ("{A}", 2, {"ows_N": "1e10"}), (None, 3, {"ows_N": "7"})]
    raw = spark.createDataFrame(raw, "list_guid string, item_id bigint, raw map<string,string>")
    fields = spark.createDataFrame([("{A}", 0, "N", "Zahl", "Number", None)], "list_guid string, pos int, name string, display_name string, type string, result_type string")
    out = sink.contract_items(raw.drop("raw"), decode.decode_items(raw, fields), fields)
    assert out.columns == ["list_guid", "item_id", "fields", "field_display_names"]
    got = {r["item_id"]: r["f"] for r in out.select("item_id", F.to_json("fields").alias("f")).collect()}
    assert got == {1: '{"Gone":"x","N":1.5,"Title":"b"}', 2: '{"N":1.0E10}', 3: None}


def test_identified_rows_stay_where_they_are_dealt(spark):
    raw = spark.createDataFrame([("{A}", 1, {"ows_ID": "1;#1"}), ("{A}", 2, {"ows_ID": ""})], "list_guid string, item_id bigint, raw map<string,string>")
    lists = spark.createDataFrame([("{A}", "Alpha", "http://sp/a", "0", "", "")], "guid string, title string, web_url string, base_type string, root_folder string, default_view_url string")
    kept, _dropped = decode.split_by_item_id(raw)
    assert [r["item_id"] for r in scope.build_items(kept, lists, identified=True).collect()] == [1] == [r["item_id"] for r in scope.build_items(raw, lists).collect()]
    dealt = scope.build_items(kept.repartition(3, "list_guid", "item_id"), lists, identified=True).dropDuplicates(["item_id", "list_guid"])
    assert dealt._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
