"""Captured bodies, fault texts, redaction and retrieval documents."""

from __future__ import annotations

import base64
import json
import os
import re
from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed, wire
from ..scale import broadcast_if_small


def _starts_within(body: Column, marker: str, head: int | None) -> Column:
    """Whether ``marker`` occurs, given ``head`` inside the first ``head`` characters."""
    at = F.locate(marker, body)
    return at > 0 if head is None else (at > 0) & (at <= head - len(marker) + 1)


def classify_payloads(pages: DataFrame, body: str = "body", head: int | None = None, page_head: int | None = None) -> DataFrame:
    """Add ``payload``: why a body is not the reply that was asked for, first match wins.

    Whole bodies are looked at; ``head`` and ``page_head`` limit that to their first characters.
    """
    low = F.lower(F.col(body))
    blank = F.btrim(F.coalesce(F.col(body), F.lit("")), F.lit(" \t\n\r\x0b\x0c")) == ""
    form = _starts_within(low, "<form", head) & _starts_within(low, 'name="__viewstate"', head)
    page = F.ltrim(low, F.lit(" \t\n\r\x0b\x0c")).startswith("<html") | _starts_within(low, "<html", page_head)
    kind = (
        F.when(blank, "empty")
        .when(_starts_within(low, fixed.UNKNOWN_OPERATION_MARKER, head), "unsupported_operation")
        .when(_starts_within(low, "login.aspx", head) | form, "login_form")
        .when(page, "html_page")
        .when(~_starts_within(low, "envelope", head), "not_an_envelope")
        .otherwise("envelope_without_result")
    )
    return pages.withColumn("payload", kind)


def fold_space(c: Column) -> Column:
    return F.regexp_replace(wire.strip(c), r"(?U)[\s\x1c-\x1f]+", " ")


def extract_error_message(bodies: DataFrame, body: str = "body", snippet: int | None = None) -> DataFrame:
    """Add ``message``: the server's own reason, from a JSON or XML error, else the body (its first ``snippet`` characters)."""
    text = wire.strip(F.coalesce(F.col(body), F.lit("")))
    node = F.try_variant_get(F.try_parse_json(text), "$.error.message", "variant")
    nested = F.schema_of_variant(node).startswith("OBJECT")
    said = F.when(nested, F.try_variant_get(node, "$.value", "variant")).otherwise(node)
    from_json = F.when(F.schema_of_variant(said) == "STRING", F.try_variant_get(said, "$", "string"))
    low = F.lower(text)
    spaced = r"(?is)<m:message[^>]*>(.*?)</"
    bare = r"(?is)<message[^>]*>(.*?)</"
    from_xml = F.when(low.contains("<m:message"), F.regexp_extract(text, spaced, 1)).when(
        low.contains("<message"), F.regexp_extract(text, bare, 1)
    )
    start = fold_space(text) if snippet is None else F.substring(fold_space(text), 1, snippet)
    message = (
        F.when(fold_space(from_json) != "", fold_space(from_json))
        .when(fold_space(from_xml) != "", fold_space(from_xml))
        .when(start != "", start)
        .otherwise("(empty body)")
    )
    return bodies.withColumn("message", message)


def _unescape_xml(c: Column) -> Column:
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


_FAULT = f"(?i){fixed.FAULT_START}"
_FAULT_BODY = f"(?is){fixed.FAULT}"


def extract_faults(pages: DataFrame, body: str = "body", head: int | None = None) -> DataFrame:
    """Add the four fault texts and whether the reply is an application error or worth a retry.

    Patterns instead of an XML parser, so a damaged body gives NULL and not an error.
    """
    whole = F.col(body)
    inner = F.when(whole.rlike(_FAULT_BODY), F.regexp_extract(whole, _FAULT_BODY, 1))

    def text_of(tag: str) -> Column:
        found = F.regexp_extract(inner, rf"(?is)<(?:[\w.-]+:)?{tag}(?:\s[^>]*)?>(.*?)</(?:[\w.-]+:)?{tag}\s*>", 1)
        text = wire.strip(_unescape_xml(F.regexp_replace(found, r"<!\[CDATA\[|\]\]>", "")))
        return F.when(text != "", text)

    at = F.regexp_instr(whole, F.lit(_FAULT))
    mark = F.length(F.regexp_extract(whole, _FAULT, 0))
    near = at > 0 if head is None else (at > 0) & (at + mark - 1 <= head)
    application = F.coalesce(near, F.lit(False))
    return pages.select(
        "*",
        F.when(inner.isNotNull(), F.coalesce(text_of("faultstring"), F.lit("unknown SOAP fault"))).alias("faultstring"),
        text_of("faultcode").alias("faultcode"),
        text_of("errorcode").alias("errorcode"),
        text_of("errorstring").alias("errorstring"),
        application.alias("application_error"),
        (~application).alias("retryable"),
    )


def is_throttled(*texts: Column) -> Column:
    """Whether any of the throttling markers occurs in the texts."""
    hay = F.lower(F.concat_ws(" ", *texts))
    return F.exists(F.array(*[F.lit(m) for m in fixed.THROTTLE_MARKERS]), lambda m: F.contains(hay, m))


def secret_forms(secrets: Sequence[str], user: str | None = None) -> list[str]:
    """Every form a secret travels in, longest first. Secrets under three characters are ignored."""
    forms: set[str] = set()
    for secret in secrets:
        if not secret or len(secret) < fixed.MIN_SECRET:
            continue
        forms |= {secret, quote(secret, safe=""), base64.b64encode(secret.encode()).decode()}
        if user:
            pair = f"{user}:{secret}"
            forms |= {base64.b64encode(pair.encode()).decode(), quote(pair, safe="")}
    return sorted(forms, key=lambda f: (-len(f), f))


def _json_forms(forms: Sequence[str]) -> list[str]:
    """The forms as they stand inside JSON text, plain and with everything but ASCII escaped."""
    inside = {json.dumps(f, ensure_ascii=ascii_only)[1:-1] for f in forms for ascii_only in (False, True)}
    inside |= {f.replace("/", "\\/") for f in inside}
    return sorted(inside, key=lambda f: (-len(f), f))


def _literal(text: str) -> str:
    return re.sub(r"([^0-9A-Za-z\x80-\U0010ffff])", r"\\\1", text)


def _choice(branches: Sequence[tuple[str, str]]) -> str:
    """One of several branches with different first characters; halves are told apart by a look at that character."""
    if len(branches) <= 4:
        return "|".join(pattern for _, pattern in branches)
    half = len(branches) // 2
    first = "".join(_literal(c) for c, _ in branches[:half])
    return f"(?=[{first}])(?:{_choice(branches[:half])})|{_choice(branches[half:])}"


def longest_of(forms: Sequence[str]) -> str:
    """A pattern that matches the longest of ``forms`` at a place: their trie, its chains as plain text.

    At each place a match looks at a few characters per level of the trie, however many forms there are.
    """

    def render(ends: Sequence[str]) -> str:
        """``ends``: distinct sorted rests of the forms that share what stands before."""
        optional = ends[0] == ""
        by_first: dict[str, list[str]] = {}
        for end in ends[optional:]:
            by_first.setdefault(end[0], []).append(end)
        branches = []
        for first, same in by_first.items():
            shared = os.path.commonprefix(same)
            branches.append((first, _literal(shared) + render([e[len(shared) :] for e in same])))
        if not branches:
            return ""
        inside = _choice(branches)
        if optional:
            return f"(?:{inside})?"
        return inside if len(branches) == 1 else f"(?:{inside})"

    return render(sorted(set(forms)))


def _replaced(c: Column, forms: Sequence[str]) -> Column:
    return F.regexp_replace(c, longest_of(forms), fixed.REDACTED.replace("\\", "\\\\").replace("$", "\\$")) if forms else c


def _scrub(c: Column, dtype: T.DataType, forms: Sequence[str]) -> Column:
    if isinstance(dtype, T.StringType):
        return _replaced(c, forms)
    if isinstance(dtype, T.VariantType):
        return F.parse_json(_replaced(F.to_json(c), _json_forms(forms)))
    if isinstance(dtype, T.ArrayType) and _holds_text(dtype.elementType):
        return F.transform(c, lambda x: _scrub(x, dtype.elementType, forms))
    if isinstance(dtype, T.MapType) and _holds_text(dtype):
        values = F.transform_values(c, lambda _k, v: _scrub(v, dtype.valueType, forms))
        return F.transform_keys(values, lambda k, _v: _scrub(k, dtype.keyType, forms))
    if isinstance(dtype, T.StructType) and _holds_text(dtype):
        parts = [_scrub(c[f.name], f.dataType, forms).alias(f.name) for f in dtype.fields]
        return F.when(c.isNotNull(), F.struct(*parts))
    return c


def _holds_text(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(_holds_text(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _holds_text(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return _holds_text(dtype.keyType) or _holds_text(dtype.valueType)
    return isinstance(dtype, (T.StringType, T.VariantType))


def redact(df: DataFrame, secrets: Sequence[str], user: str | None = None) -> DataFrame:
    """Replace every form of every secret in all texts: nested ones, map keys and variants included.

    One pass per text with one pattern: at each place the longest form goes. Neither the plan nor the time per text follows
    the number of secrets.
    """
    forms = secret_forms(secrets, user)
    return df.select(*[_scrub(F.col(f"`{f.name}`"), f.dataType, forms).alias(f.name) for f in df.schema.fields])


def display_text(item_fields: DataFrame) -> Column:
    """One readable text per decoded value; NULL for values that are absent or empty."""
    refs = F.array_join(F.transform("v_refs", lambda r: F.coalesce(r["value"], r["id"].cast("string"))), ", ")
    address = F.concat_ws(" ", "v_url.description", "v_url.url")
    text = F.coalesce(
        F.col("v_string"),
        F.col("v_double").cast("string"),
        F.col("v_bigint").cast("string"),
        F.col("v_bool").cast("string"),
        wire.instant_to_json(F.col("v_ts")),
        refs,
        F.array_join("v_strings", ", "),
        F.when(F.col("v_url").isNotNull(), address),
    )
    return F.when(text != "", text)


def build_documents(items: DataFrame, item_fields: DataFrame, list_fields: DataFrame) -> DataFrame:
    """One text per item: a ``display name: value`` line per filled field, folders left out.

    Lines follow the schema order, undeclared fields come last by name. An item has as
    many lines as its list has columns.
    """
    shown = list_fields.select(
        "list_guid", F.col("name").alias("field"), F.col("pos").alias("_pos"), "display_name"
    )
    rows = item_fields.join(broadcast_if_small(shown), ["list_guid", "field"], "left")
    pos = F.coalesce("_pos", F.lit(2**31 - 1))
    line = F.concat(F.coalesce("display_name", "field"), F.lit(": "), display_text(item_fields))
    lines = rows.select("list_guid", "item_id", pos.alias("_pos"), "field", line.alias("_line")).filter(F.col("_line").isNotNull())
    texts = (
        lines.groupBy("list_guid", "item_id")
        .agg(F.array_sort(F.collect_list(F.struct("_pos", "field", "_line"))).alias("_l"))
        .select("list_guid", "item_id", F.concat_ws("\n", F.col("_l._line")).alias("text"))
    )
    heads = items.filter(~F.col("is_folder")).select(
        "list_guid",
        "item_id",
        F.col("doc_id").alias("id"),
        F.col("display_url").alias("source_url"),
        F.col("list_title").alias("list"),
        "modified",
    )
    joined = heads.join(texts, ["list_guid", "item_id"], "left")
    return joined.select("id", F.coalesce("text", F.lit("")).alias("text"), "source_url", "list", "modified")


def document_lookups(item_fields: DataFrame, edges: DataFrame, items: DataFrame) -> DataFrame:
    """Which items a document refers to: one row per document, field and id, with the list the id belongs to."""
    targets = edges.select(F.col("source_list_guid").alias("list_guid"), F.col("field_name").alias("field"), "target_list_guid")
    refs = item_fields.select("list_guid", "item_id", "field", F.explode("v_refs").alias("r")).filter("r.id IS NOT NULL")
    named = refs.join(broadcast_if_small(targets), ["list_guid", "field"])
    heads = items.filter(~F.col("is_folder")).select("list_guid", "item_id", F.col("doc_id").alias("id"))
    return named.join(heads, ["list_guid", "item_id"]).select("id", "field", "target_list_guid", F.col("r.id").alias("target_item_id"))


def document_files(attachments: DataFrame) -> DataFrame:
    """Files that were downloaded for a document, one row each."""
    return attachments.filter("downloaded").select(F.col("doc_id").alias("id"), "filename", "local_path")
