"""Decode rules: one row per wire form, blanks for every type, damage, and random text."""

import random

import pytest
from pyspark.sql import functions as F

from listloom.functions import fixed, names, wire
from listloom.operators import decode

EXPLODED = "list_guid string, item_id bigint, field string, wire_type string, result_type string, raw string"


def run(spark, cases):
    rows = [("{L}", i, c.get("field", "F"), c["type"], c.get("result"), c["raw"]) for i, c in enumerate(cases)]
    out = decode.decode_fields(spark.createDataFrame(rows, EXPLODED)).withColumn("v_ts", F.date_format("v_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return {r["item_id"]: r.asDict(recursive=True) for r in out.collect()}


def ref(id_, value, term=None):
    return {"id": id_, "value": value, "term_guid": term}


GUID = "9F8E7D6C-0000-1111-2222-333344445555"
CASES = [
    ("Text", "<b>x</b> ", "v_string", "<b>x</b> ", None),
    ("Text", "", "v_string", "", None),
    ("SomethingNew", "7;#x", "v_string", "7;#x", None),
    ("Number", " 871.250000000000", "v_double", 871.25, None),
    ("Number", "1e3", "v_double", 1000.0, None),
    ("Number", ".5", "v_double", 0.5, None),
    ("Number", "1d", "v_double", None, "number_unparseable"),
    ("Number", "0x10", "v_double", None, "number_unparseable"),
    ("Currency", "12,5", "v_double", None, "number_unparseable"),
    ("Number", " ", "v_double", None, None),
    ("Integer", "63.9", "v_bigint", 63, None),
    ("Counter", "-7", "v_bigint", -7, None),
    ("Integer", "99999999999999999999", "v_bigint", None, "int_unparseable"),
    ("Integer", "nan", "v_bigint", None, "int_unparseable"),
    ("Boolean", "YES", "v_bool", True, None),
    ("Boolean", "-1", "v_bool", True, None),
    ("AllDayEvent", "off", "v_bool", False, None),
    ("Boolean", "ja", "v_bool", None, "boolean_unparseable"),
    ("DateTime", "2016-11-05T19:27:00Z", "v_ts", "2016-11-05 19:27:00.000000", None),
    ("DateTime", "2009-3-4", "v_ts", "2009-03-04 00:00:00.000000", None),
    ("DateTime", "2016-11-05 19:27:00.25", "v_ts", "2016-11-05 19:27:00.250000", None),
    ("DateTime", "2016-11-05T19:27:00+0200", "v_ts", "2016-11-05 17:27:00.000000", None),
    ("DateTime", "20100101", "v_ts", "2010-01-01 00:00:00.000000", None),
    ("DateTime", "12:30", "v_ts", None, "datetime_unparseable"),
    ("DateTime", "2009", "v_ts", None, "datetime_unparseable"),
    ("DateTime", "2009-13-01", "v_ts", None, "datetime_unparseable"),
    ("Choice", ";#Hoch;#", "v_string", "Hoch", None),
    ("Choice", ";#;#", "v_string", None, None),
    ("Choice", "Hoch;#x", "v_string", "Hoch;#x", None),
    ("MultiChoice", ";#A;#;#B;#", "v_strings", ["A", "B"], None),
    ("GridChoice", "", "v_strings", [], None),
    ("Lookup", "63;#Özdemir KG", "v_refs", [ref(63, "Özdemir KG")], None),
    ("Lookup", "63", "v_refs", [ref(63, None)], None),
    ("Lookup", "-5", "v_refs", [ref(None, "-5")], "lookup_without_id"),
    ("Lookup", "Özdemir", "v_refs", [ref(None, "Özdemir")], "lookup_without_id"),
    ("Lookup", "63;#A;#B", "v_refs", [ref(63, "A;#B")], "lookup_odd_tokens"),
    ("Lookup", "63;#A;#B;#C", "v_refs", [ref(63, "A;#B;#C")], "lookup_odd_tokens"),
    ("Lookup", "x;#A", "v_refs", [ref(None, "x;#A")], None),
    ("Lookup", ";#", "v_refs", None, None),
    ("User", "12;#DOM\\jdoe", "v_refs", [ref(12, "DOM\\jdoe")], None),
    ("File", "1;#a.pdf", "v_refs", [ref(1, "a.pdf")], None),
    ("LookupMulti", "63;#A;#57;#B AG", "v_refs", [ref(63, "A"), ref(57, "B AG")], None),
    ("LookupMulti", "63;#A;#57", "v_refs", [ref(63, "A")], "lookup_multi_odd_tokens"),
    ("LookupMulti", "63", "v_refs", [], "lookup_multi_odd_tokens"),
    ("UserMulti", " ", "v_refs", [], None),
    ("TaxonomyFieldType", f"3;#A|B|{GUID}", "v_refs", [ref(3, "A|B", GUID.lower())], None),
    ("TaxonomyFieldType", "3;#A|B", "v_refs", [ref(3, "A|B")], None),
    ("TaxonomyFieldTypeMulti", f"3;#A|{GUID};#4;#C", "v_refs", [ref(3, "A", GUID.lower()), ref(4, "C")], None),
    ("URL", "http://x/17, Text, mehr", "v_url", {"url": "http://x/17", "description": "Text, mehr"}, None),
    ("URL", "http://x/17,b", "v_url", {"url": "http://x/17,b", "description": None}, None),
    ("URL", " ", "v_url", None, None),
    ("Attachments", "http://x/f", "v_bool", True, None),
    ("Attachments", "", "v_bool", False, None),
    ("Calculated", "float;#1469.055", "v_double", 1469.055, None),
    ("Calculated", "DateTime;#2009-03-21 00:00:00", "v_ts", "2009-03-21 00:00:00.000000", None),
    ("Calculated", "float;#x", "v_double", None, "number_unparseable"),
    ("Calculated", "farbe;#rot;#x", "v_string", "rot;#x", "calculated_unknown_prefix"),
    ("Calculated", "plain", "v_string", "plain", None),
    ("Calculated", " ", "v_string", None, None),
]


def test_wire_forms(spark):
    got = run(spark, [{"type": t, "raw": r} for t, r, *_ in CASES])
    for i, (wire_type, raw, slot, expected, warning) in enumerate(CASES):
        row = got[i]
        assert row[slot] == expected, (wire_type, raw, row[slot])
        assert row["warnings"] == ([warning] if warning else []), (wire_type, raw, row["warnings"])
        others = [s for s in decode.ITEM_FIELD_COLUMNS if s not in (slot, "warnings")]
        assert all(row[s] is None for s in others), (wire_type, raw, row)


def test_result_type_and_names(spark):
    got = run(
        spark,
        [
            {"type": "Calculated", "raw": "7.5", "result": "Number"},
            {"type": "Calculated", "raw": "7.5", "result": "Strange"},
            {"type": "Text", "field": "FSObjType", "raw": "1;#0"},
            {"type": "Integer", "field": "FSObjType", "raw": "x"},
            {"type": "Text", "field": "AttachmentUrls", "raw": ";# http://a ;#;#http://b;#"},
        ],
    )
    assert got[0]["v_double"] == 7.5 and got[1]["v_string"] == "7.5"
    assert got[2]["v_bigint"] == 0 and got[3]["v_bigint"] is None and got[3]["warnings"] == []
    assert got[4]["v_strings"] == ["http://a", "http://b"]


def test_null_gives_null_everywhere(spark):
    types = set(fixed.SYSTEM_FIELD_TYPES.values()) | {c[0] for c in CASES}
    for row in run(spark, [{"type": t, "raw": None} for t in sorted(types)]).values():
        assert all(row[s] is None for s in decode.ITEM_FIELD_COLUMNS if s != "warnings"), row
        assert row["warnings"] == []


def _tokens(text):
    text = text.strip()
    text = text.removeprefix(";#")
    text = text.removesuffix(";#")
    return text.split(";#") if text else []


def test_random_text_never_fails(spark):
    rng = random.Random(7)
    alphabet = [";#", ";", "#", "1", "63", "x", "ü", " ", "\t", "|", ", ", "-", "T", ":", "2016-11-05", "Z", " ", "."]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(8))) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for r in df.select("t", wire.tokens(F.col("t")).alias("k")).collect():
        assert r["k"] == _tokens(r["t"]), repr(r["t"])
    types = sorted({c[0] for c in CASES})
    rows = [{"type": t, "raw": x} for t in types for x in texts[:120]]
    assert len(run(spark, rows)) == len(rows)


def test_system_types_and_prefixes(spark):
    raw = spark.createDataFrame([("{A}", 1, {"ows_Author": "1;#x", "ows_Mine": "5", "ows_MetaInfo": "bag", "other": "y", "ows_Odd": "z"})], "list_guid string, item_id bigint, raw map<string,string>")
    fields = spark.createDataFrame([("{A}", 0, "Mine", "Integer", None), ("{B}", 0, "Odd", "Integer", None)], "list_guid string, pos int, name string, type string, result_type string")
    got = {r["field"]: r["wire_type"] for r in decode.explode_fields(raw, fields).collect()}
    assert got == {"Author": "User", "Mine": "Integer", "Odd": "Text"}
    kept = raw.select(wire.strip_wire_prefix(F.col("raw")).alias("m")).first()["m"]
    assert set(kept) == {"Author", "Mine", "Odd"}


@pytest.mark.parametrize(
    ("raw", "expected"),
    [({"ows_ID": "7"}, 7), ({"ID": " 7 "}, 7), ({"Id": "7;#x"}, 7), ({"ows_ID": ";#8;#"}, 8), ({"ows_ID": "x7"}, None), ({"Id": "7.0"}, None), ({}, None), ({"ows_ID": "-3"}, -3)],
)
def test_item_id(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "raw map<string,string>")
    assert df.select(wire.item_id(F.col("raw"))).first()[0] == expected


def test_names(spark):
    rows = [("HTTP://Farm:80/A b/?q#f", "http://farm:80/A b"), ("plain/path/", "plain/path"), (" http://x/ ", "http://x")]
    df = spark.createDataFrame(rows, "u string, e string")
    assert all(r["n"] == r["e"] for r in df.select("e", names.normalise_url(F.col("u")).alias("n")).collect())
    pairs = [("Case Number", "Case_x0020_Number"), ("ü_ß", "_x00fc__x005f__x00df_"), ("a😀", "a_x1f600_")]
    df = spark.createDataFrame(pairs, "plain string, escaped string")
    for r in df.select("escaped", names.escape_name(F.col("plain")).alias("e"), "plain", names.unescape_name(F.col("escaped")).alias("p")).collect():
        assert r["e"] == r["escaped"]
        if "😀" not in r["plain"]:
            assert r["p"] == r["plain"]
    import uuid

    url = "http://farm/sites/ü"
    got = spark.range(1).select(names.web_id(F.lit(url))).first()[0]
    assert got == str(uuid.uuid5(uuid.NAMESPACE_URL, url))
    assert spark.range(1).select(names.normalise_guid(F.lit("{ab-1}")), names.normalise_guid(F.lit("ab-1")), names.normalise_guid(F.lit(None).cast("string"))).first()[:] == ("{AB-1}", "{AB-1}", "")


def test_file_names(spark):
    cases = {
        "http://x/a/scan%20one.pdf?v=1": "scan one.pdf", "http://x/a/b+c.txt": "b+c.txt", "http://x/": "unnamed", "http://x/100%.txt": "100%.txt",
        "x/a%2Fb.txt": "a_b.txt",
    }
    df = spark.createDataFrame(list(cases.items()), "u string, e string")
    for r in df.select("u", "e", names.file_name_from_url(F.col("u")).alias("n")).collect():
        assert r["n"] == r["e"], r["u"]
    kinds = {"a.ZIP": "archive", ".zip": "other", "a.tar.gz": "archive", "dir.zip/readme": "other", "a.": "other", "x.heic": "image"}
    df = spark.createDataFrame(list(kinds.items()), "n string, e string")
    for r in df.select("n", "e", names.file_kind(F.col("n")).alias("k")).collect():
        assert r["k"] == r["e"], r["n"]
