"""Readers on hand-written captures, writers, snapshots and streams."""

import json

import pytest
from pyspark.sql import functions as F

from listloom import session
from listloom.operators import decode, graph, scope
from listloom.operators.incremental import latest_per_key
from listloom.sinks import contract
from listloom.sinks import landing as sink
from listloom.sources import captured
from listloom.sources import landing as source
from listloom.streaming import feeds

ENVELOPE = '<?xml version="1.0" encoding="utf-8"?>\n<soap:Envelope xmlns:soap="urn:s"><soap:Body><r xmlns:rs="urn:rs" xmlns:z="urn:z">{}</r></soap:Body></soap:Envelope>'


def put(path, body):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(body, encoding="utf-8")
    return str(path.parent)


def test_rowset_pages(spark, tmp_path):
    page = '<rs:data ItemCount="2" ListItemCollectionPositionNext="Paged=TRUE&amp;p_ID=2"><z:row ows_ID="1" ows_Title=" Ölwechsel &amp; &lt;b&gt; " ows_Case_x0020_Number="007"/><z:row ows_ID="2;#x" ows_Title=""/></rs:data>'
    put(tmp_path / "p" / "page1.xml", ENVELOPE.format(page))
    path = put(tmp_path / "p" / "page2.xml", ENVELOPE.format('<rs:data ItemCount="0"></rs:data>'))
    pages = captured.read_rowset_pages(spark, path, ["ID", "Title", "Case_x0020_Number", "Absent"])
    info = {r["item_count"]: (r["position_next"], len(r["rows"])) for r in pages.collect()}
    assert info == {2: ("Paged=TRUE&p_ID=2", 2), 0: (None, 0)}
    rows = {r["item_id"]: r["raw"] for r in captured.page_rows(pages).collect()}
    assert rows[1] == {"ows_ID": "1", "ows_Title": " Ölwechsel & <b> ", "ows_Case_x0020_Number": "007"}
    assert rows[2] == {"ows_ID": "2;#x", "ows_Title": ""}


def test_change_pages(spark, tmp_path):
    one = '<listitems><Changes LastChangeToken="1;3;a" MoreChanges="TRUE"><Id ChangeType="Delete">2</Id><Id ChangeType="Delete">zwei</Id></Changes><rs:data ItemCount="1"><z:row ows_ID="1" ows_Title="neu"/></rs:data></listitems>'
    two = '<listitems><Changes><Id ChangeType="InvalidToken"/></Changes></listitems>'
    put(tmp_path / "c" / "page10.xml", ENVELOPE.format(one))
    path = put(tmp_path / "c" / "page11.xml", ENVELOPE.format(two))
    pages = captured.read_change_pages(spark, path, ["ID", "Title"])
    got = {r["page_no"]: (r["last_change_token"], r["more_changes"], r["token_invalid"]) for r in pages.collect()}
    assert got == {10: ("1;3;a", True, False), 11: (None, False, True)}
    rows = captured.change_rows(pages, F.lit("{A}")).orderBy("seq").collect()
    assert [(r["item_id"], r["change_type"], r["seq"]["page"]["page_no"], r["seq"]["pos"]) for r in rows] == [(2, "delete", 10, 0), (1, "update", 10, 2)]
    assert [r["raw"] for r in captured.undecodable_deletes(pages).collect()] == ["zwei"]


def test_json_feeds(spark, tmp_path):
    shapes = ['{"d":{"results":[{"Id":1},7,{"Id":2}],"__next":"n"}}', '{"d":[{"Id":3}]}', '{"d":{"Id":4}}', '{"x":1}', "<html>", "[1", ""]
    for i, body in enumerate(shapes):
        path = put(tmp_path / "j" / f"{i}.json", body)
    rows = captured.read_odata_json(spark, path).select(F.try_variant_get("row", "$.Id", "bigint").alias("i"), "next").collect()
    assert sorted((r["i"], r["next"]) for r in rows) == [(1, "n"), (2, "n"), (3, None), (4, None)]


ATOM = """<feed xmlns="urn:a" xmlns:d="urn:d" xmlns:m="urn:m"><entry>
<link rel="edit" href="e"/><link rel="urn:x/related/Kunde" href="k"><m:inline><entry><content type="application/xml"><m:properties><d:Id m:type="Edm.Int32">63</d:Id><d:Title>Özdemir "A"</d:Title></m:properties></content></entry></m:inline></link>
<link rel="urn:x/related/Teile" href="t"><m:inline><feed><entry><content><m:properties><d:Id m:type="Edm.Int32">5</d:Id></m:properties></content></entry><entry><content><m:properties><d:Id m:type="Edm.Int32">6</d:Id></m:properties></content></entry></feed></m:inline></link>
<link rel="urn:x/related/Attachments" href="a/b"/>
<content type="application/xml"><m:properties><d:Id m:type="Edm.Int32">1</d:Id><d:Title>T &amp; &lt;b&gt;</d:Title><d:Kosten m:type="Edm.Decimal">871.25</d:Kosten><d:Wert m:type="Edm.Double">2.5</d:Wert><d:Ok m:type="Edm.Boolean">true</d:Ok>
<d:Leer m:type="Edm.Int32" m:null="true"/><d:Art><d:element>x</d:element><d:element>y</d:element></d:Art><d:Kaputt m:type="Edm.Int32">viel</d:Kaputt></m:properties></content></entry>
<entry><content src="f"/><m:properties><d:Id m:type="Edm.Int32">2</d:Id></m:properties></entry></feed>"""


def test_atom_feed_equals_json_feed(spark, tmp_path):
    path = put(tmp_path / "a" / "page.xml", ATOM)
    properties = ["Id", "Title", "Kosten", "Wert", "Ok", "Leer", "Art", "Kaputt", "Absent"]
    rows = [json.loads(r["j"]) for r in captured.read_odata_atom(spark, path, properties).select(F.to_json("row").alias("j")).collect()]
    assert {r["Id"]: r for r in rows} == {
        1: {
            "Id": 1, "Title": "T & <b>", "Kosten": "871.25", "Wert": 2.5, "Ok": True, "Leer": None, "Art": {"results": ["x", "y"]}, "Kaputt": "viel",
            "Kunde": {"Id": 63, "Title": 'Özdemir "A"'}, "Teile": {"results": [{"Id": 5}, {"Id": 6}]}, "Attachments": {"__deferred": {"uri": "a/b"}},
        },
        2: {"Id": 2},
    }


def test_schemas_and_inventories(spark, tmp_path):
    body = """<List ID="{ab}" Title="Fälle" BaseType="0" ItemCount="drei" EnableAttachments="Yes" HasUniqueScopes="1" RootFolder="/r"><Fields>
<Field Name="Kunde" DisplayName="Kunde" Type="Lookup" List="{cd-1}" Required="TRUE" MaxLength="0"/><Field StaticName="Vor" Type="Lookup" List="Self" MaxLength="64"/>
<Field DisplayName="Art" Type="MultiChoice"><CHOICES><CHOICE> A </CHOICE><CHOICE>B</CHOICE></CHOICES><Formula>=1</Formula></Field></Fields></List>"""
    path = put(tmp_path / "s" / "list.xml", ENVELOPE.format(body))
    lists, fields = captured.read_list_schemas(spark, path)
    row = lists.first().asDict()
    assert (row["guid"], row["item_count"], row["enable_attachments"], row["has_unique_scopes"], row["hidden"]) == ("{AB}", 0, True, True, False)
    got = [(r["pos"], r["name"], r["lookup_list"], r["max_length"], r["required"], r["choices"], r["formula"]) for r in fields.orderBy("pos").collect()]
    assert got == [(0, "Kunde", "{CD-1}", None, True, [], None), (1, "Vor", "Self", 64, False, [], None), (2, "Art", None, None, False, ["A", "B"], "=1")]
    webs = put(tmp_path / "w" / "w.xml", ENVELOPE.format('<Webs><Web Title="S" Url="http://sp/a"/><Web Title="x" Url=""/></Webs>'))
    assert [tuple(r)[:2] for r in captured.read_web_inventory(spark, webs).collect()] == [("S", "http://sp/a")]


def landing_inputs(spark, titles):
    lists = spark.createDataFrame([("{A}", "Alpha", "http://sp/a", "0", "", ""), ("{B}", "Beta", "http://sp/a", "0", "", "")], "guid string, title string, web_url string, base_type string, root_folder string, default_view_url string")
    fields = spark.createDataFrame([("{A}", 0, "Title", "Titel", "Text", None), ("{A}", 1, "Ref", "Bezug", "Lookup", None)], "list_guid string, pos int, name string, display_name string, type string, result_type string")
    rows = [(g, i, {"ows_ID": str(i), "ows_Title": x, "ows_Ref": "3;#drei", "ows_Created": "2016-11-05T19:27:00Z", "ows_MetaInfo": "m"}) for g, i, x in titles]
    raw = spark.createDataFrame(rows, "list_guid string, item_id bigint, raw map<string,string>")
    records = scope.build_items(raw, lists, keep_raw=True)
    items = sink.contract_items(records.drop("raw"), decode.decode_items(raw, fields), fields)
    return items, records, lists


def test_landing_replaces_and_clears(spark, tmp_path):
    root = str(tmp_path / "landing")
    sink.write_landing(*landing_inputs(spark, [("{A}", 1, "eins"), ("{A}", 2, "zwei"), ("{B}", 1, "b")]), root)
    assert source.read_items(spark, root).count() == 3
    items, records, lists = landing_inputs(spark, [("{A}", 1, "neu")])
    sink.write_landing(items, records, lists.filter("guid = '{A}'"), root)
    assert {(r["list_guid"], r["item_id"]) for r in source.read_items(spark, root).collect()} == {("{A}", 1), ("{B}", 1)}
    sink.write_landing(items, records, lists, root)
    out = source.read_items(spark, root)
    row = out.select("*", F.to_json("fields").alias("f")).collect()
    assert len(row) == 1 and json.loads(row[0]["f"]) == {"ID": 1, "Title": "neu", "Ref": {"id": 3, "value": "drei"}, "Created": "2016-11-05T19:27:00Z"}
    assert row[0]["created"] == "2016-11-05T19:27:00Z" and row[0]["display_url"] == "http://sp/a/DispForm.aspx?ID=1"
    raw = source.read_raw_items(spark, root).collect()
    assert [set(r["raw"]) for r in raw] == [{"ID", "Title", "Ref", "Created"}]
    assert (tmp_path / "landing" / "items" / "web_slug=sp_a" / "list_slug=b").exists()


def test_contract_layout_is_read_and_written(spark, tmp_path):
    folder = tmp_path / "c" / "webs" / "farm_a" / "lists" / "7"
    file = {"filename": "f.txt", "url": "u", "downloaded": True, "bytes": 3}
    put(folder / "items.jsonl", json.dumps({"doc_id": "d", "item_id": 4, "fields": {"A": 1}, "attachments": [file, file]}) + "\n\n{\n")
    put(folder / "items_raw.jsonl", '{"ows_ID": "4", "ows_A": "1"}\n')
    put(folder / "list.json", json.dumps({"list_info": {"guid": "{7}", "title": "T"}, "fields": [{"name": "A", "type": "Text"}]}, indent=2))
    root = str(tmp_path / "c")
    items = source.read_contract_items(spark, root)
    assert [(r["doc_id"], r["web_slug"], r["list_slug"]) for r in items.collect()] == [("d", "farm_a", "7")]
    assert source.contract_attachments(items).count() == 2
    assert [r["raw"]["ows_ID"] for r in source.read_contract_raw_items(spark, root).collect()] == ["4"]
    lists, fields = source.read_contract_schemas(spark, root)
    assert [r["title"] for r in lists.collect()] == ["T"] and [r["name"] for r in fields.collect()] == ["A"]


def contract_run(spark, rows, root, guids=("{A}", "{B}"), **more):
    """Writes ``rows`` of two lists of a web to the contract's layout."""
    _, records, lists = landing_inputs(spark, rows)
    lists = lists.where(F.col("guid").isin(*guids))
    fields = spark.createDataFrame([("{A}", 0, "Ref", "Bezug", "Lookup", "{B}", "Title", False)], "list_guid string, pos int, name string, display_name string, type string, lookup_list string, show_field string, mult boolean")
    items = records.withColumns({"fields": F.parse_json(F.lit('{"Title":"x"}')), "field_display_names": F.create_map(F.lit("Ref"), F.lit("Bezug"))})
    webs = spark.createDataFrame([("W", "http://sp/a", "id")], "title string, url string, web_id string")
    lists = lists.withColumn("item_count", F.lit(1).cast("bigint"))
    contract.write_contract_landing(items, lists, fields, webs, graph.build_graph_nodes(lists), graph.build_graph_edges(lists, fields), root, **more)
    return items


def test_contract_writer_lays_out_the_files_of_the_contract(spark, tmp_path):
    root = str(tmp_path / "c")
    files = spark.createDataFrame([("u2", "b.txt"), ("u1", "a.txt")], "url string, filename string")
    extra = {"local_path": F.lit(None).cast("string"), "bytes": F.lit(3).cast("bigint"), "sha256": F.lit(None).cast("string"), "downloaded": F.lit(True), "skip_reason": F.lit(None).cast("string")}
    doc = contract_run(spark, [("{A}", 2, "zwei"), ("{A}", 1, "eins")], root).where("item_id = 1").first()["doc_id"]
    contract_run(spark, [("{A}", 2, "zwei"), ("{A}", 1, "eins")], root, attachments=files.withColumns({"doc_id": F.lit(doc), **extra}))
    base = tmp_path / "c"
    found = sorted(str(p.relative_to(base)) for p in base.rglob("*") if p.is_file() and not p.name.startswith("."))
    own = "webs/sp_a/lists"
    assert found == sorted(["_graph.json", f"{own}/a/items.jsonl", f"{own}/a/items_raw.jsonl", f"{own}/a/list.json", f"{own}/b/items.jsonl", f"{own}/b/items_raw.jsonl", f"{own}/b/list.json", "webs.json", "webs/sp_a/web.json"])
    lines = [json.loads(x) for x in (base / own / "a" / "items.jsonl").read_text().splitlines()]
    raw = [json.loads(x) for x in (base / own / "a" / "items_raw.jsonl").read_text().splitlines()]
    assert [x["item_id"] for x in lines] == [1, 2] and [x["ID"] for x in raw] == ["1", "2"] and raw[0]["Title"] == "eins"
    assert "raw" not in lines[0] and [[f["url"] for f in x["attachments"]] for x in lines] == [["u1", "u2"], []]
    assert (base / own / "b" / "items.jsonl").read_text() == "" == (base / own / "b" / "items_raw.jsonl").read_text()
    schema = json.loads((base / own / "a" / "list.json").read_text())
    assert schema["list_info"]["guid"] == "{A}" and [f["name"] for f in schema["fields"]] == ["Ref"]
    webs, web = json.loads((base / "webs.json").read_text()), json.loads((base / "webs" / "sp_a" / "web.json").read_text())
    assert webs == {"webs": [web], "count": 1} and web["list_count"] == 2 and [x["guid"] for x in web["lists"]] == ["{A}", "{B}"]
    drawn = json.loads((base / "_graph.json").read_text())
    assert [n["list_guid"] for n in drawn["nodes"]] == ["{A}", "{B}"] and [(e["field_name"], e["dangling"]) for e in drawn["edges"]] == [("Ref", False)]
    assert [(r["list_slug"], r["item_id"]) for r in source.read_contract_items(spark, root).orderBy("item_id").collect()] == [("a", 1), ("a", 2)]
    assert {r["raw"]["Title"] for r in source.read_contract_raw_items(spark, root).collect()} == {"eins", "zwei"}
    assert [r["slug"] for r in source.read_contract_webs(spark, root)[0].collect()] == ["sp_a"] and source.read_contract_graph(spark, root)[1].count() == 1


def test_contract_writer_replaces_continues_and_splits(spark, tmp_path):
    root = str(tmp_path / "c")

    def ids(name="items.jsonl"):
        rows = source.read_contract_items(spark, root) if name == "items.jsonl" else source.read_contract_raw_items(spark, root).select("list_slug", F.col("raw")["ID"].cast("bigint").alias("item_id"))
        return sorted((r["list_slug"], r["item_id"]) for r in rows.collect())

    contract_run(spark, [("{A}", 1, "x"), ("{B}", 7, "y")], root)
    contract_run(spark, [("{A}", 2, "x")], root, guids=("{A}",))
    assert ids() == [("a", 2), ("b", 7)]
    contract_run(spark, [("{A}", 3, "x")], root, guids=("{A}",), resume=True)
    contract_run(spark, [("{A}", 4, "x")], root, resume=True)
    assert ids() == [("a", 2), ("a", 3), ("a", 4), ("b", 7)] == ids("raw")
    many = [("{A}", i, "x") for i in range(2000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        contract_run(spark, many, root)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert ids() == [("a", i) for i in range(2000)] == ids("raw")
    parts = sorted((tmp_path / "c" / "webs" / "sp_a" / "lists" / "a" / "items.jsonl").iterdir())
    written = [json.loads(x)["item_id"] for p in parts if p.name.startswith("part") for x in p.read_text().splitlines()]
    assert len(parts) > 1 and written == list(range(2000))


def test_contract_writer_puts_nothing_in_place_when_a_task_fails(spark, tmp_path):
    root = str(tmp_path / "c")
    contract_run(spark, [("{A}", 1, "x")], root)
    before = {p: p.read_text() for p in (tmp_path / "c").rglob("*") if p.is_file() and p.suffix != ".crc"}
    rows = spark.range(0, 400, 1, 4).select(
        F.lit("webs/sp_a/lists/a").alias("folder"), F.lit("items.jsonl").alias("file"), F.lit(None).cast("string").alias("section"),
        F.when(F.col("id") < 399, "{}").otherwise(F.raise_error(F.lit("boom"))).alias("body"), F.lit("{}").alias("twin"),
    )
    with pytest.raises(Exception, match="boom"):
        rows.write.format("contract_landing").mode("overwrite").save(root)
    assert {p: p.read_text() for p in (tmp_path / "c").rglob("*") if p.is_file() and p.suffix != ".crc"} == before
    assert not list((tmp_path / "c").glob("_staging*"))


def test_stores_of_the_contract_writer():
    assert contract.open_store("/a/b")[1] == contract.open_store("file:/a/b")[1] == contract.open_store("file:///a/b")[1] == "/a/b"
    with pytest.raises(ValueError, match="viewfs"):
        contract.open_store("viewfs://x/a")


def test_damaged_lines_are_skipped_and_counted(spark, tmp_path):
    good = json.dumps({"doc_id": "d", "item_id": 1, "list_guid": "{A}"})
    put(tmp_path / "l" / "items" / "web_slug=w" / "list_slug=a" / "part.txt", f'{good}\n\n{{"doc_id": "e", "item\n  \n')
    root = str(tmp_path / "l")
    assert [r["doc_id"] for r in source.read_items(spark, root).collect()] == ["d"]
    assert source.skipped_lines(spark, root).count() == 1


def test_run_documents(spark, tmp_path):
    """Damaged documents give no rows; good ones give manifests and states."""
    root = str(tmp_path / "r")
    put(tmp_path / "r" / "runs" / "bad.json", '{"run_id": "1", "warnings": ')
    assert all(t.count() == 0 for t in source.read_run_tables(spark, root).values())
    put(tmp_path / "r" / "lists" / "bad.json", "no json\n")
    assert all(t.count() == 0 for t in source.read_stored_schemas(spark, root))
    manifest = {"command": "crawl", "counts": {"lists_failed": 1}, "warnings": ["w"], "errors": [{"scope": "items", "message": "m", "list_guid": "{A}"}]}
    put(tmp_path / "m" / "one.json", json.dumps(manifest, indent=2))
    path = put(tmp_path / "m" / "two.json", '{"command": "sync"')
    tables = source.read_manifests(spark, path)
    assert [(r["counter"], r["n"]) for r in tables["counts"].collect()] == [("lists_failed", 1)]
    assert [r["message"] for r in tables["errors"].collect()] == ["m"] and tables["runs"].count() == 1
    state = {"lists": {"{A}": {"status": "failed", "last_item_id": 7}, "{B}": {"status": "complete"}}}
    put(tmp_path / "s" / "state.json", json.dumps(state, indent=1))
    path = put(tmp_path / "s" / "bad.json", "{")
    got = {r["list_guid"]: (r["status"], r["last_item_id"]) for r in source.read_states(spark, path).collect()}
    assert got == {"{A}": ("failed", 7), "{B}": ("complete", None)}
    put(tmp_path / "run" / "_manifest.json", json.dumps(manifest, indent=2))
    put(tmp_path / "run" / "_state.json", json.dumps(state, indent=2))
    assert source.read_contract_manifest(spark, str(tmp_path / "run"))["runs"].count() == 1
    assert source.read_contract_state(spark, str(tmp_path / "run")).count() == 2


def test_snapshots(spark, tmp_path):
    table = str(tmp_path / "t")
    with pytest.raises(ValueError):
        sink.read_snapshot(spark, table)
    sink.publish_snapshot(spark.range(3), table)
    old = sink.read_snapshot(spark, table)
    sink.publish_snapshot(old.filter("id > 0"), table)
    assert sink.read_snapshot(spark, table).count() == 2 and old.count() == 3
    # A version without its pointer row is never seen.
    spark.range(9).write.parquet(f"{table}/data/3-x")
    assert sink.read_snapshot(spark, table).count() == 2


def change_page(n, rows, deletes=()):
    ids = "".join(f'<Id ChangeType="Delete">{d}</Id>' for d in deletes)
    body = "".join(f'<z:row ows_ID="{i}" ows_Title="{x}"/>' for i, x in rows)
    return ENVELOPE.format(f'<listitems><Changes LastChangeToken="t{n}" MoreChanges="FALSE">{ids}</Changes><rs:data ItemCount="{len(rows)}">{body}</rs:data></listitems>')


def test_changes_of_any_file_name_and_several_pages_in_a_file(spark, tmp_path):
    def listitems(page):
        return page[page.index("<listitems>") : page.index("</r>")]

    one, two = listitems(change_page(1, [(1, "old"), (2, "b")])), listitems(change_page(2, [(1, "new")]))
    path = put(tmp_path / "p" / "changes.xml", ENVELOPE.format(one + two))
    put(tmp_path / "p" / "changes_20240131120000.xml", change_page(3, [(2, "c")]))
    rows = captured.change_rows(captured.read_change_pages(spark, path, ["ID", "Title"]), F.lit("{A}"))
    last = latest_per_key(rows.withColumn("title", F.try_element_at("raw", F.lit("ows_Title"))).drop("raw"))
    assert {(r["item_id"], r["title"]) for r in last.collect()} == {(1, "new"), (2, "c")}
    assert rows.filter("seq IS NULL").count() == 0


def test_attachments_are_written_whole_and_read_back(spark, tmp_path):
    root = str(tmp_path / "landing")
    items, records, lists = landing_inputs(spark, [("{A}", 1, "eins"), ("{B}", 1, "b")])
    one = records.select("doc_id", "web_url", "list_guid")
    files = one.join(spark.range(10_050), F.col("list_guid") == "{A}").select(
        "*", F.concat(F.lit("f"), F.col("id").cast("string")).alias("filename"), F.lit("u").alias("url"), F.lit(None).cast("string").alias("local_path"),
        F.lit(1).cast("bigint").alias("bytes"), F.lit(None).cast("string").alias("sha256"), F.lit(True).alias("downloaded"), F.lit(None).cast("string").alias("skip_reason"),
    )
    sink.write_landing(items, records, lists, root, files)
    assert source.read_attachments(spark, root).agg(F.count_distinct("filename")).first()[0] == 10_050
    # Another run of list B leaves the files of list A alone.
    sink.write_landing(items.filter("list_guid = '{B}'"), records.filter("list_guid = '{B}'"), lists.filter("guid = '{B}'"), root, files.limit(0))
    assert source.read_attachments(spark, root).count() == 10_050


def test_items_sent_twice_are_one_line(spark, tmp_path):
    root = str(tmp_path / "landing")
    items, records, lists = landing_inputs(spark, [("{A}", 1, "eins"), ("{A}", 1, "eins")])
    sink.write_landing(items, records.dropDuplicates(["doc_id"]), lists, root)
    assert source.read_items(spark, root).count() == 1


@pytest.mark.parametrize("per_batch", [1, None])
def test_change_stream(spark, tmp_path, per_batch):
    """The same pages in many or one batch give the same table; a restart takes only what is new."""
    pages, table, progress = tmp_path / "pages", str(tmp_path / "table"), str(tmp_path / "progress")
    base = spark.createDataFrame([("{A}", 1, "one"), ("{A}", 2, "two"), ("{A}", 3, "three")], "list_guid string, item_id bigint, title string")
    sink.publish_snapshot(base, table)
    put(pages / "p1.xml", change_page(1, [(1, "ONE"), (2, "TWO")]))
    path = put(pages / "p2.xml", change_page(2, [(4, "four")], deletes=[2]))

    def shape(rows):
        return rows.select("list_guid", "item_id", "change_type", F.try_element_at("raw", F.lit("ows_Title")).alias("title"), "seq")

    def load():
        rows = feeds.stream_change_pages(spark, path, ["ID", "Title"], F.lit("{A}"), per_batch)
        feeds.change_stream(rows, table, progress, shape).awaitTermination()

    def table_rows():
        return {(r["item_id"], r["title"]) for r in feeds.current_rows(spark, table).collect()}

    load()
    assert table_rows() == {(1, "ONE"), (3, "three"), (4, "four")}
    feeds.compact(spark, table)
    assert table_rows() == {(1, "ONE"), (3, "three"), (4, "four")} and sink.read_snapshot(spark, table).count() == 3
    put(pages / "p3.xml", change_page(3, [(2, "again")], deletes=[1]))
    load()
    assert table_rows() == {(2, "again"), (3, "three"), (4, "four")}
    assert feeds.lists_to_reload(spark, table).count() == 0
    put(pages / "p4.xml", ENVELOPE.format('<listitems><Changes><Id ChangeType="InvalidToken"/></Changes></listitems>'))
    put(pages / "p5.xml", change_page(5, [(9, "too late")]))
    load()
    assert table_rows() == {(2, "again"), (3, "three"), (4, "four")}
    flagged = feeds.lists_to_reload(spark, table).collect()
    assert [r["list_guid"] for r in flagged] == ["{A}"]
    feeds.compact(spark, table)
    assert table_rows() == {(2, "again"), (3, "three"), (4, "four")}
    assert feeds.lists_to_reload(spark, table, flagged[0]["batch_id"]).count() == 0


def test_change_stream_keeps_its_cost_and_order(spark, tmp_path):
    """Late lower pages never win, also after ``compact``; what a batch reads does not grow with batches run."""
    pages, table, progress = tmp_path / "pages", str(tmp_path / "table"), str(tmp_path / "progress")
    sink.publish_snapshot(spark.createDataFrame([("{A}", 1, "one")], "list_guid string, item_id bigint, title string"), table)

    def shape(rows):
        return rows.select("list_guid", "item_id", "change_type", F.try_element_at("raw", F.lit("ows_Title")).alias("title"), "seq")

    def send(name, body, guid="{A}"):
        path = put(pages / f"{name}.xml", body)
        rows = feeds.stream_change_pages(spark, path, ["ID", "Title"], F.lit(guid), 1)
        rows = rows.withColumn("page_no", F.regexp_extract("last_change_token", r"(\d+)$", 1).cast("bigint"))
        feeds.change_stream(rows, table, progress, shape).awaitTermination()

    def now():
        return {(r["item_id"], r["title"]) for r in feeds.current_rows(spark, table).collect()}

    send("a", change_page(7, [(1, "seven"), (2, "seven")], deletes=[3]))
    send("b", change_page(5, [(1, "five")]))
    assert now() == {(1, "seven"), (2, "seven")}
    feeds.compact(spark, table)
    assert not list((tmp_path / "table" / "changes").glob("batch_id=*"))
    send("c", change_page(6, [(1, "six"), (2, "six"), (3, "six"), (4, "six")]))
    assert now() == {(1, "seven"), (2, "seven"), (4, "six")}
    feeds.compact(spark, table)
    feeds.compact(spark, table)
    assert now() == {(1, "seven"), (2, "seven"), (4, "six")}
    send("d", change_page(8, [(3, "eight")], deletes=[1]))
    for i in range(4):
        send(f"e{i}", change_page(9 + i, [(9, str(i))]))
        feeds.compact(spark, table)
    assert now() == {(2, "seven"), (3, "eight"), (4, "six"), (9, "3")}
    assert feeds.lists_to_reload(spark, table).count() == 0 and not (tmp_path / "table" / "stops").exists()
    for i in range(3):
        send(f"x{i}", ENVELOPE.format(f'<listitems><Changes LastChangeToken="1;3;{20 + i}"><Id ChangeType="InvalidToken"/></Changes></listitems>'))
    flagged = feeds.lists_to_reload(spark, table)
    assert flagged.count() == 1
    send("y", change_page(30, [(5, "too late")]))
    assert (5, "too late") not in now()
    for kept in ("data", "_versions", "applied/data", "applied/_versions", "stops/data", "stops/_versions"):
        assert len([p for p in (tmp_path / "table" / kept).iterdir() if not p.name.startswith((".", "_"))]) <= 2
    feeds.note_reload(spark, table, flagged)
    assert feeds.lists_to_reload(spark, table).count() == 0
    send("z", change_page(31, [(5, "after the reload")]))
    assert (5, "after the reload") in now()


def test_live_children_are_those_of_the_batch_join(spark, tmp_path):
    """A child in front of its parent, a late child, a childless parent, a child beyond the time."""
    parents = [(1, "2024-01-01 10:00:00"), (2, "2024-01-01 11:00:00"), (3, "2024-01-01 12:00:00")]
    kids = [(10, 1, "2024-01-01 09:58:00"), (11, 1, "2024-01-01 12:00:00"), (12, 1, "2024-01-01 17:00:00"), (13, 3, "2024-01-01 12:30:00"), (14, 9, "2024-01-01 12:00:00")]
    far = "2024-03-01 00:00:00"
    steps = [("c", kids[:1]), ("p", parents), ("c", [kids[2], kids[3]]), ("c", [kids[1], kids[4]]), ("p", [(-1, far)]), ("c", [(-1, -1, far)])]
    shapes = {"p": ("id bigint", "opened"), "c": ("cid bigint, fk bigint", "said")}
    for kind in "pc":
        (tmp_path / kind).mkdir()
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    for i, (kind, rows) in enumerate(steps):
        keys, at = shapes[kind]
        lines = "".join(json.dumps(dict(zip([*(k.split()[0] for k in keys.split(", ")), at], r))) + "\n" for r in rows)
        (tmp_path / kind / f"{i}.json").write_text(lines)
        if rows == [(-1, far)]:
            continue  # the ends of both streams come in one run
        streams = {k: spark.readStream.schema(f"{names}, {time} timestamp").json(str(tmp_path / k)) for k, (names, time) in shapes.items()}
        live = feeds.live_children(streams["p"], streams["c"], "id", "fk", "opened", "said", "1 day", "5 MINUTES", "4 HOURS")
        job = live.select("id", "cid").writeStream.format("parquet").option("path", out).option("checkpointLocation", progress)
        job.trigger(availableNow=True).start().awaitTermination()
    got = {tuple(r) for r in spark.read.parquet(out).where("id >= 0").collect()}
    assert got == {(1, 10), (1, 11), (2, None), (3, 13)}


def test_page_stream_resumes(spark, tmp_path):
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    path = put(tmp_path / "in" / "p1.xml", ENVELOPE.format('<rs:data ItemCount="1"><z:row ows_ID="1"/></rs:data>'))
    feeds.page_stream(feeds.stream_pages(spark, path, ["ID"]), out, progress).awaitTermination()
    put(tmp_path / "in" / "p2.xml", ENVELOPE.format('<rs:data ItemCount="2"><z:row ows_ID="2"/><z:row ows_ID="3"/></rs:data>'))
    for _ in range(2):
        feeds.page_stream(feeds.stream_pages(spark, path, ["ID"]), out, progress).awaitTermination()
    assert sorted(r["item_id"] for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_shared_folder_comes_from_the_session(spark):
    assert session.scratch_path(spark, "x").startswith(session.shared_dir(spark))
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == (configured or spark.sparkContext.getCheckpointDir())
    assert spark.sparkContext.getCheckpointDir()
