"""Joins, graph, change feeds, text and reports on tiny tables."""

import bisect
import hashlib
import random
import re
import resource

import pytest
from pyspark.sql import functions as F

from listloom.operators import decode, files, graph, joins, odata, reports, scope, text
from listloom.operators import incremental as inc


def test_thread_puts_undated_first(spark):
    parents = spark.createDataFrame([(1,), (1,), (2,)], "id bigint")
    kids = spark.createDataFrame(
        [(1, "2020-01-02", 5), (1, None, 9), (1, "2020-01-01", 7), (1, "2020-01-02", 4), (None, None, 1), (3, None, 2)], "fk bigint, at string, cid int"
    )
    out = joins.attach_children_in_parts(parents, kids, "id", "fk", F.col("at").try_cast("timestamp"), [F.col("cid")], ["cid"], 10).collect()
    got = sorted((r["id"], [c["cid"] for c in r["comments"]]) for r in out)
    assert got == [(1, [9, 7, 4, 5]), (1, [9, 7, 4, 5]), (2, [])]
    cover = joins.join_coverage(parents, kids, "id", "fk").first().asDict()
    assert cover == {"parents": 3, "matched_parents": 2, "children": 6, "orphans": 1, "unmatched_parents": 1}
    none = joins.attach_children_in_parts(parents, kids.limit(0), "id", "fk", F.col("at").try_cast("timestamp"), [F.col("cid")], ["cid"], 10)
    assert [r["comments"] for r in none.collect()] == [[], [], []]


def test_parent_key_detection(spark):
    assert joins.candidate_parent_keys(["Id", "TicketNumberId", "ErstelltVonId", "geändertVonId", "owshiddenversionId", "parentref", "Title", "CaseID"]) == [
        "TicketNumberId", "parentref", "CaseID",
    ]
    kids = spark.createDataFrame([(1, "9", 7), (2, "x", 7), (2, "9", None)], "TicketId bigint, OtherID string, FillId bigint")
    parents = spark.createDataFrame([(1,), (2,)], "Id bigint")
    assert joins.detect_parent_key(kids, parents, "Id").first().asDict() == {"candidate": "TicketId", "hits": 3, "populated": 3}
    assert joins.detect_parent_key(kids, None).first()["candidate"] == "TicketId"
    assert joins.detect_parent_key(kids.select(F.col("OtherID").alias("Title")), parents, "Id").count() == 0


def test_lookups_follow_ids_over_two_levels(spark):
    ref = "array<struct<id:bigint,value:string,term_guid:string>>"
    fields = spark.createDataFrame(
        [("{A}", 1, "B", None, [(5, "old", None), (6, "x", None)]), ("{B}", 5, "Title", "new", None), ("{B}", 5, "C", None, [(8, "c", None)]), ("{C}", 8, "Title", "c", None)],
        f"list_guid string, item_id bigint, field string, v_string string, v_refs {ref}",
    ).withColumns({"v_bigint": F.lit(None).cast("bigint"), "v_double": F.lit(None).cast("double")})
    edges = spark.createDataFrame([("{A}", "B", "{B}", "Title"), ("{B}", "C", "{C}", None)], "source_list_guid string, field_name string, target_list_guid string, show_field string")
    items = fields.select("list_guid", "item_id").distinct()
    labels = joins.show_labels(items, fields, edges)
    out = {(r["level"], r["list_guid"], r["field"], r["target_id"]): (r["current_label"], r["target_found"]) for r in joins.resolve_lookups(fields, edges, labels, depth=2).collect()}
    assert out == {
        (1, "{A}", "B", 5): ("new", True), (1, "{A}", "B", 6): (None, False), (1, "{B}", "C", 8): ("c", True), (2, "{A}", "B/C", 8): ("c", True),
    }


def test_people_without_a_table(spark):
    kids = spark.createDataFrame([(1, 7)], "id int, CreatedById int")
    assert joins.resolve_people(kids, None, "CreatedById").first()["author"] is None


def test_name_matching(spark):
    available = spark.createDataFrame([("Lagerplätze", 0), ("LagerPlatze", 1), ("KUNDEN", 2), ("kunden", 3), ("Straße", 4)], "name string, pos int")
    wanted = spark.createDataFrame([("Lager Plätze",), ("Kunden",), ("STRASSE",), ("Nichts",)], "name string")
    got = {r["wanted"]: (r["match"], r["ambiguous"], r["fallback"]) for r in joins.match_collections(wanted, available).collect()}
    assert got == {"Lager Plätze": ("Lagerplätze", False, False), "Kunden": ("KUNDEN", True, False), "STRASSE": ("Straße", False, False), "Nichts": (None, False, True)}


def test_hierarchy(spark):
    edges = spark.createDataFrame(
        [("r", "a", "", 0), ("r", "b", "B", 1), ("a", "c", "C", 0), ("c", "r", "Root", 0), ("b", "a", "A", 0), ("b", "d", "D", 1), ("d", "e", "E", 0)],
        "parent string, child string, title string, pos int",
    )
    closed = spark.createDataFrame([("d",)], "url string")
    got = {r["url"]: (r["title"], r["depth"], r["status"]) for r in graph.walk_hierarchy(edges, "r", closed).collect()}
    assert got == {"r": ("Root", 0, "read"), "a": ("A", 1, "read"), "b": ("B", 1, "read"), "c": ("C", 2, "read"), "d": ("D", 2, "unreadable")}
    summary = graph.walk_summary(graph.walk_hierarchy(edges, "r", closed)).first()
    assert (summary["webs"], summary["depth_reached"], summary["complete"]) == (5, 2, False)
    limited = {r["url"]: r["status"] for r in graph.walk_hierarchy(edges, "r", max_depth=1).collect()}
    assert limited == {"r": "read", "a": "depth_limit", "b": "depth_limit"}
    assert graph.walk_summary(graph.walk_hierarchy(edges, "r", max_depth=1)).first()["complete"] is False
    chain = spark.range(40).select(F.col("id").cast("string").alias("parent"), (F.col("id") + 1).cast("string").alias("child"), F.lit("").alias("title"), F.lit(0).alias("pos"))
    deep = graph.walk_summary(graph.walk_hierarchy(chain, "0")).first()
    assert (deep["depth_reached"], deep["complete"]) == (40, True)
    with pytest.raises(ValueError):
        graph.walk_hierarchy(edges, "d", closed)


CHANGES = "list_guid string, item_id bigint, change_type string, title string, seq bigint"


def test_changes(spark):
    target = spark.createDataFrame([("{A}", 1, "one"), ("{A}", 2, "two"), ("{A}", 3, "three")], "list_guid string, item_id bigint, title string")
    feed = spark.createDataFrame(
        [("{A}", 1, "Update", "x", 1), ("{A}", 1, "Update", "ONE", 2), ("{A}", 2, "Update", "y", 3), ("{A}", 2, "delete", None, 4), ("{A}", 9, "Delete", None, 5), ("{A}", 4, "Delete", None, 6), ("{A}", 4, "Update", "FOUR", 7)],
        CHANGES,
    )
    upserts, deletes = inc.split_changes(inc.latest_per_key(feed))
    got = {(r["item_id"], r["title"]) for r in inc.apply_changes(target, upserts, deletes).collect()}
    assert got == {(1, "ONE"), (3, "three"), (4, "FOUR")}
    # Unordered sets: a key both changed and deleted stays.
    both = feed.filter("seq = 3"), feed.filter("seq = 4")
    assert (2, "y") in {(r["item_id"], r["title"]) for r in inc.apply_changes(target, *both).collect()}
    report = inc.sync_report(target, upserts, deletes).first().asDict()
    assert report == {"list_guid": "{A}", "updated": 2, "deleted": 2, "replaced": 2, "removed": 1}


def test_truncate_and_schema_check(spark):
    rows = spark.createDataFrame([("{A}", 1), ("{A}", None), ("{A}", 9), ("{B}", 1)], "list_guid string, item_id bigint")
    state = spark.createDataFrame([("{A}", 5)], "list_guid string, last_item_id bigint")
    assert {tuple(r) for r in inc.truncate_after(rows, state).collect()} == {("{A}", 1), ("{B}", 1)}
    inc.check_append_schema(rows, rows, "item_id")
    with pytest.raises(ValueError, match="have: item_id, list_guid"):
        inc.check_append_schema(rows, rows.withColumn("ID", F.lit(1)), "ID")


def test_file_plan(spark):
    lists = spark.createDataFrame([("{G}", "0"), ("{D}", "1")], "guid string, base_type string")
    raw = spark.createDataFrame(
        [
            ("{D}", 1, {"ows_EncodedAbsUrl": "http://x/a%20b.pdf", "ows_FileLeafRef": "1;#a b.pdf", "ows_FSObjType": "1;#0"}),
            ("{D}", 2, {"ows_EncodedAbsUrl": "http://x/dir", "ows_FSObjType": "2;#1"}),
            ("{G}", 3, {"ows_Attachments": "1", "ows_AttachmentUrls": "http://x/1.txt;#http://x/2%3F.txt"}),
            ("{G}", 4, {"ows_Attachments": "1"}),
            ("{G}", 5, {"ows_Attachments": "0"}),
        ],
        "list_guid string, item_id bigint, raw map<string,string>",
    )
    got = sorted((r["item_id"], r["file_name"], r["needs_listing"]) for r in files.plan_files(raw, lists).collect())
    assert got == [(1, "a b.pdf", False), (3, "1.txt", False), (3, "2_.txt", False), (4, None, True)]


def test_walk_of_a_long_chain_takes_few_rounds(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(graph, "materialise", lambda df, kept=graph.materialise: rounds.append(1) or kept(df))
    n = 100_000
    up = F.col("id").cast("string").alias("parent")
    chain = spark.range(n).select(up, (F.col("id") + 1).cast("string").alias("child"), F.concat(F.lit("t"), F.col("id")).alias("title"), F.lit(0).alias("pos"))
    walked = graph.walk_hierarchy(chain, "0")
    summary = graph.walk_summary(walked).first()
    assert (summary["webs"], summary["depth_reached"], summary["complete"]) == (n + 1, n, True)
    assert len(rounds) <= 22
    assert walked.where(f"url = '{n}'").first()["title"] == f"t{n - 1}"


def plain_walk(edges, root, lost, limit):
    """Breadth first, level by level: depth and status, and the best title of each url."""
    depth, level, titles = {root: 0}, [root], {}
    while level:
        found = []
        for p in level:
            if p in lost or (limit is not None and depth[p] >= limit):
                continue
            for parent, child, title, pos in edges:
                if parent == p:
                    if title:
                        titles.setdefault(child, []).append((depth[p] + 1, parent, pos, title))
                    if child not in depth:
                        depth[child] = depth[p] + 1
                        found.append(child)
        level = found
    status = {u: "unreadable" if u in lost else "depth_limit" if limit is not None and d >= limit else "read" for u, d in depth.items()}
    return {(u, min(titles[u])[3] if u in titles else "", d, status[u]) for u, d in depth.items()}


def test_walks_of_odd_hierarchies(spark):
    """Several parents, circles, self edges, urls nothing leads to."""
    draw = random.Random(3)
    tree = [(str(draw.randrange(max(0, i - 3), i)), str(i), draw.choice(["", None, f"t{i}"]), i) for i in range(1, 40)]
    more = [(str(draw.randrange(40)), str(draw.randrange(40)), draw.choice(["", "z", "a"]), -draw.randrange(9)) for _ in range(8)]
    circle = [("x", "y", "", 1), ("y", "x", "", 1), ("q", "r", "", 1), ("5", "5", "self", 1), ("7", "0", "root", 2)]
    lone = [("m", "n", "", 1), ("n", "o", "", 1), ("o", "n", "", 1)]
    for rows, lost, limit in ((tree, [], None), (tree + more + circle, ["4"], None), (more + circle + lone, [], None), (tree + more, ["6", "9"], 5), ([], [], None)):
        edges = spark.createDataFrame(rows, "parent string, child string, title string, pos bigint")
        closed = spark.createDataFrame([(u,) for u in lost], "url string")
        got = {tuple(r) for r in graph.walk_hierarchy(edges, "0", closed, limit).collect()}
        assert got == plain_walk(rows, "0", lost, limit)


def test_redaction_is_longest_first_and_nested(spark):
    forms = text.secret_forms(["s3cret!", "ab", ""], "user")
    assert forms == sorted(forms, key=lambda f: (-len(f), f)) and "ab" not in forms and len(forms) == 5
    row = ("pw s3cret! dXNlcjpzM2NyZXQh", {"auth": ["s3cret%21", "ok"]}, 5)
    df = spark.createDataFrame([row], "a string, m map<string,array<string>>, n int")
    got = text.redact(df, ["s3cret!", "ab"], "user").first()
    assert got["a"] == "pw ***REDACTED*** ***REDACTED***"
    assert got["m"] == {"auth": ["***REDACTED***", "ok"]} and got["n"] == 5
    nested = df.select(F.parse_json(F.lit('{"k s3cret!":["x s3cret!",1]}')).alias("v"), F.create_map(F.lit("s3cret!"), F.lit(1)).alias("keys"))
    got = text.redact(nested, ["s3cret!"]).select(F.to_json("v").alias("v"), "keys").first()
    assert got["v"] == '{"k ***REDACTED***":["x ***REDACTED***",1]}' and got["keys"] == {"***REDACTED***": 1}


def test_many_secrets_are_one_pattern_in_one_pass(spark):
    draw = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJ0123456789.*+?()[]{}|^$\\/-_ é𝄞"
    secrets = sorted({"".join(draw.choice(letters) for _ in range(draw.randrange(3, 12))) for _ in range(1000)})
    secrets += [s[:-1] for s in secrets[:50] if len(s) > 4] + ["aaa", "aaaa", "aaaab"]
    texts = ["".join(draw.choice([*secrets, *letters]) for _ in range(30)) for _ in range(200)] + ["aaaaab aaa", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, a string").coalesce(1)
    forms = text.secret_forms(secrets)
    plain = re.compile("|".join(re.escape(f) for f in sorted(forms, key=len, reverse=True)))
    out = text.redact(df, secrets)
    got = {r["i"]: r["a"] for r in out.collect()}
    assert got == {i: x if x is None else plain.sub("***REDACTED***", x) for i, x in enumerate(texts)}
    assert not any(f in x.replace("***REDACTED***", "\n") for x in got.values() if x for f in forms)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 1 and "replace(replace(" not in plan
    assert text.longest_of(["ab", "abc", "abd", "x"]) == "(?:ab(?:c|d)?|x)"
    assert text.redact(df, ["a"]).exceptAll(df).isEmpty()


def test_census_at_every_level(spark):
    rows = [("A", "x.pdf", 1), ("A", "y.pdf", 1), ("A", "z.zip", 2), ("B", "w.pdf", 3), (None, "v.pdf", 4)]
    df = spark.createDataFrame(rows, "list string, name string, item int")
    got = {(r["level"], r["list"], r["kind"]): (r["files"], r["items"]) for r in reports.file_census(df, "name", "list", "item").collect()}
    assert got == {
        ("list and kind", "A", "document"): (2, 1), ("list and kind", "A", "archive"): (1, 1), ("list and kind", "B", "document"): (1, 1), ("list and kind", None, "document"): (1, 1),
        ("list", "A", None): (3, 2), ("list", "B", None): (1, 1), ("list", None, None): (1, 1), ("kind", None, "document"): (4, 3), ("kind", None, "archive"): (1, 1), ("all", None, None): (5, 4),
    }


def test_median_of_merged_sketches(spark):
    log = spark.range(50_000).select(
        F.when(F.col("id") % 5 == 0, "a").otherwise("b").alias("operation"), F.lit(200).alias("status"), (F.col("id") % 7).alias("day"), F.lit(1).alias("bytes"), F.lit(2).alias("rows"),
        F.when(F.col("id") % 11 != 0, F.pow(F.col("id") / 1000, 2)).alias("duration"), F.lit(None).cast("double").alias("wait"),
    )
    idle = log.limit(3).withColumns({"operation": F.lit("c"), "duration": F.lit(None).cast("double")})
    sketches = reports.traffic_sketches(log.unionByName(idle), ["operation", "status", "day"])
    got = {r["operation"]: r for r in reports.merge_traffic(sketches).collect()}
    assert got["c"]["median_duration"] is None and got["c"]["requests"] == 3
    for name in "ab":
        ranked = sorted(r["duration"] for r in log.where(F.col("operation") == name).collect() if r["duration"] is not None)
        place = bisect.bisect(ranked, got[name]["median_duration"]) / len(ranked)
        assert abs(place - 0.5) <= reports.SKETCH_ERROR
        assert got[name]["requests"] == {"a": 10_000, "b": 40_000}[name]


def test_payload_windows(spark):
    bodies = [
        (" ", "empty"), ("x" * 503 + "<html", "html_page"), ("x" * 509 + "<html", "not_an_envelope"), ("x" * 8184 + "envelope", "envelope_without_result"),
        ("x" * 8185 + "envelope", "not_an_envelope"), ("<HTML><a href='/Login.aspx'>", "login_form"),
    ]
    df = spark.createDataFrame([(i, b) for i, (b, _e) in enumerate(bodies)], "i int, body string")
    got = {r["i"]: r["payload"] for r in text.classify_payloads(df, head=8192, page_head=512).collect()}
    assert got == {i: e for i, (_b, e) in enumerate(bodies)}
    whole = {r["i"]: r["payload"] for r in text.classify_payloads(df).collect()}
    assert whole[2] == "html_page" and whole[4] == "envelope_without_result"


def test_error_messages(spark):
    cases = [
        ('{"error":{"code":"","message":{"lang":"de","value":" Ein\\n Fehler "}}}', "Ein Fehler"), ('{"error":{"message":"kurz"}}', "kurz"),
        ('{"error":{"message":{"value":5}}}', '{"error":{"message":{"value":5}}}'), ("<error><message xml:lang='x'>a  b</message></error>", "a b"),
        ("", "(empty body)"), (None, "(empty body)"), ("[1", "[1"), ("y" * 400, "y" * 400),
    ]
    df = spark.createDataFrame([(i, b) for i, (b, _e) in enumerate(cases)], "i int, body string")
    got = {r["i"]: r["message"] for r in text.extract_error_message(df).collect()}
    assert got == {i: e for i, (_b, e) in enumerate(cases)}


def test_documents_skip_empty_values_and_folders(spark):
    exploded = spark.createDataFrame(
        [("{L}", 1, f, t, None, r) for f, t, r in [("B", "Text", "b"), ("A", "LookupMulti", "1;#x;#2;#y"), ("C", "Text", ""), ("D", "MultiChoice", ""), ("E", "Boolean", "1")]] + [("{L}", 2, "A", "Text", None, "q")],
        "list_guid string, item_id bigint, field string, wire_type string, result_type string, raw string",
    )
    fields = spark.createDataFrame([("{L}", 0, "A", "Alpha"), ("{L}", 5000, "B", "Beta")], "list_guid string, pos int, name string, display_name string")
    items = spark.createDataFrame([("{L}", 1, "d1", "u", "L", "m", False), ("{L}", 2, "d2", "u", "L", "m", True), ("{L}", 3, "d3", "u", "L", "m", False)], "list_guid string, item_id bigint, doc_id string, display_url string, list_title string, modified string, is_folder boolean")
    decoded = decode.decode_fields(exploded)
    got = [(r["id"], r["text"]) for r in text.build_documents(items, decoded, fields).orderBy("id").collect()]
    assert got == [("d1", "Alpha: x, y\nBeta: b\nE: true"), ("d3", "")]
    edges = spark.createDataFrame([("{L}", "A", "{T}")], "source_list_guid string, field_name string, target_list_guid string")
    refs = {tuple(r) for r in text.document_lookups(decoded, edges, items).collect()}
    assert refs == {("d1", "A", "{T}", 1), ("d1", "A", "{T}", 2)}


def test_feed_rows_keep_what_they_cannot_map(spark):
    fields = spark.createDataFrame([("{L}", 0, "Case_x0020_Number", "Case Number", "Text"), ("{L}", 1, "Kunde", "Kunde", "Lookup"), ("{L}", 2, "When", "When", "DateTime"), ("{L}", 3, "ID", "ID", "Counter")], "list_guid string, pos int, name string, display_name string, type string")
    body = '{"Id":7,"CaseNumber":"20180203","KundeId":63,"Kunde":"Özdemir","When":"2011-01-01T00:00:00","Odd":{"x":1},"__metadata":{},"Files":{"__deferred":{"uri":"u"}}}'
    pages = spark.createDataFrame([(body,)], "b string").select(F.lit("{L}").alias("list_guid"), F.lit(7).cast("bigint").alias("item_id"), F.parse_json("b").alias("row"))
    got = {r["field"]: r for r in odata.map_odata_rows(pages, fields).collect()}
    assert set(got) == {"ID", "Case_x0020_Number", "Kunde", "When", "Odd"}
    assert got["Case_x0020_Number"]["v_string"] == "20180203" and got["Case_x0020_Number"]["v_ts"] is None
    assert (got["Kunde"]["v_refs"][0]["id"], got["Kunde"]["v_refs"][0]["value"]) == (63, "Özdemir")
    assert got["When"]["v_ts"].year == 2011 and got["ID"]["v_bigint"] == 7
    assert got["Odd"]["mapped"] is False and got["Odd"]["v_string"] == '{"x":1}'


def test_harmonised_tables(spark):
    a = spark.createDataFrame([(1, "x")], "Id int, Created string")
    b = spark.createDataFrame([(2, "y", 5)], "id int, Erstellt string, extra int")
    out = odata.harmonise_tables([a, b], {"key": ["Id", "ID"], "created": ["Created", "Erstellt"]})
    assert sorted((r["key"], r["created"], r["extra"]) for r in out.collect()) == [(1, "x", None), (2, "y", 5)]


def test_gate_and_reports(spark):
    counts = spark.createDataFrame([("lists_failed", 2), ("items_written", 9)], "counter string, n bigint")
    assert reports.ingest_gate(counts).first()["accepted"] is False
    with pytest.raises(ValueError, match="2 lists failed"):
        reports.require_ingestible(counts)
    sizes = spark.createDataFrame([("b", 5, None), ("A", 5, None), ("c", None, "x"), ("z", 0, None)], "name string, entries bigint, error string")
    assert [r["name"] for r in reports.collection_sizes(sizes).collect()] == ["A", "b", "z", "c"]
    lists = spark.createDataFrame([("http://x", "T", 5001)], "web_url string, title string, item_count bigint")
    assert reports.oversized_lists(lists, 12).count() == 0
    assert reports.oversized_lists(lists, 14).first()["line"] == "http://x :: T (5,001 items)"


def test_web_titles(spark):
    webs = spark.createDataFrame([("", "http://SP/a/", 0), ("First", "http://sp/a", 1), ("Second", "http://sp/a", 2), ("None", "", 3)], "title string, url string, pos int")
    got = {r["url"]: r["title"] for r in scope.normalise_webs(webs, "http://sp").collect()}
    assert got == {"http://sp/a": "First", "http://sp": ""}


def test_changes_without_an_order_are_not_lost(spark):
    feed = spark.createDataFrame([("{A}", 1, "update", "x", None)], CHANGES)
    base = spark.createDataFrame([("{A}", 1, "old")], "list_guid string, item_id bigint, title string")
    assert [r["title"] for r in inc.apply_latest(base, inc.latest_per_key(feed)).collect()] == ["x"]


def test_resume_leaves_other_lists_alone(spark):
    rows = spark.createDataFrame([("{A}", 1), ("{A}", 9), ("{B}", 5), ("{C}", 3)], "list_guid string, item_id bigint")
    state = spark.createDataFrame([("{A}", "in_progress", 4), ("{B}", "complete", None)], "list_guid string, status string, last_item_id bigint")
    assert {tuple(r) for r in inc.truncate_after(rows, state).collect()} == {("{A}", 1), ("{B}", 5), ("{C}", 3)}
    routes = inc.route_resume(state, rows)
    assert {r["list_guid"]: r["action"] for r in routes.collect()} == {"{A}": "continue", "{B}": "skip", "{C}": "reset"}
    assert {tuple(r) for r in inc.pages_to_load(rows, inc.route_resume(state)).collect()} == {("{A}", 9), ("{C}", 3)}


def test_snapshot_diff_sees_moved_values_and_maps(spark):
    def rows(a, b, names, v):
        df = spark.createDataFrame([("d", a, b, names, v)], "doc_id string, a string, b string, names map<string,int>, v string")
        return df.withColumn("v", F.parse_json("v"))

    before = rows("x", None, {"p": 1, "q": 2}, '{"k":1}')
    assert inc.snapshot_diff(before, rows("x", None, {"q": 2, "p": 1}, '{"k":1}')).count() == 0
    for after in (rows(None, "x", {"p": 1, "q": 2}, '{"k":1}'), rows("x", None, {"p": 2, "q": 1}, '{"k":1}'), rows("x", None, {"p": 1, "q": 2}, '{"k":2}')):
        assert [r["change"] for r in inc.snapshot_diff(before, after).collect()] == ["changed"]


def test_equal_snapshots_compare_digests_of_buckets_only(spark, monkeypatch):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 7).alias("a"), F.create_map(F.lit("k"), F.col("id")).alias("m"))
    compared = []
    monkeypatch.setattr(inc, "_bucket", lambda key, n, kept=inc._bucket: compared.append(1) or kept(key, n))
    assert inc.snapshot_diff(rows, rows.repartition(5)).count() == 0
    assert len(compared) == 2
    twice = rows.unionByName(rows.where("doc_id < 2"))
    digests = inc.bucket_digests(rows, "doc_id", ["a", "m"], 8).exceptAll(inc.bucket_digests(twice, "doc_id", ["a", "m"], 8))
    assert 1 <= digests.count() <= 2
    edited = rows.withColumn("a", F.when(F.col("doc_id") == 77, -1).otherwise(F.col("a"))).where("doc_id <> 99").unionByName(rows.limit(1).withColumn("doc_id", F.lit(9999).cast("bigint")))
    got = {r["doc_id"]: r["change"] for r in inc.snapshot_diff(rows, edited, buckets=64).collect()}
    assert got == {77: "changed", 99: "removed", 9999: "added"}
    assert inc.snapshot_diff(rows.limit(0), rows.limit(0)).count() == 0


def test_files_beyond_the_size_of_a_row_are_streamed(spark, tmp_path):
    folder = tmp_path / "f"
    folder.mkdir()
    size = 3 * 1024**3
    with open(folder / "large.bin", "wb") as f:
        f.truncate(size)
    (folder / "small.bin").write_bytes(b"abc")
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    got, digest = files.stream_digest(str(folder / "large.bin"))
    assert got == size and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 200 * 1024
    hashed = {r["path"].rpartition("/")[2]: (r["bytes"], r["sha256"]) for r in files.hash_files(spark, str(folder), "*.bin").collect()}
    assert hashed == {"large.bin": (size, digest), "small.bin": (3, hashlib.sha256(b"abc").hexdigest())}


def test_append_schema_counts_rows_without_a_key(spark):
    stored = spark.createDataFrame([("A", 1), ("A", None), ("B", 2), (None, 3)], "list_guid string, id int")
    incoming = spark.createDataFrame([("A", 1, None)], "list_guid string, id int, web string")
    got = {tuple(r) for r in inc.append_schema_report(stored, incoming, ["id", "web"]).collect()}
    assert got == {("A", "id", "stored", 1, 2), ("A", "web", "stored", 2, 2), ("B", "web", "stored", 1, 1), (None, "web", "stored", 1, 1), ("A", "web", "incoming", 1, 1)}
    assert inc.append_schema_report(stored.limit(0), incoming.limit(0), ["id"]).count() == 0


def test_lookups_reached_in_several_ways_are_one_row(spark):
    def field(guid, item, name, kind, raw):
        return (guid, item, name, kind, None, raw)

    rows = [field("{O}", 1, "Who", "LookupMulti", "1;#a;#2;#b"), field("{C}", 1, "Home", "Lookup", "7;#x"), field("{C}", 2, "Home", "Lookup", "7;#y"), field("{N}", 7, "Title", "Text", "Seven")]
    fields = decode.decode_fields(spark.createDataFrame(rows, "list_guid string, item_id bigint, field string, wire_type string, result_type string, raw string"))
    edges = spark.createDataFrame([("{O}", "Who", "{C}", None), ("{C}", "Home", "{N}", None)], "source_list_guid string, field_name string, target_list_guid string, show_field string")
    items = spark.createDataFrame([("{C}", 1), ("{C}", 2), ("{N}", 7)], "list_guid string, item_id bigint")
    found = joins.resolve_lookups(fields, edges, joins.show_labels(items, fields, edges), depth=2)
    assert [(r["item_id"], r["field"], r["target_id"], r["current_label"]) for r in found.where("level = 2").collect()] == [(1, "Who/Home", 7, "Seven")]
