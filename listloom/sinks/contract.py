"""The landing as other tools read it: one folder per list with its files, written by tasks and put in place by a commit."""

from __future__ import annotations

import gzip
import re
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..functions import names
from ..operators.scope import add_slugs
from ..session import require_utc, store
from ..stores import open_store

ITEMS, RAW = "items.jsonl", "items_raw.jsonl"
# Documents that list entries; these say how many.
COUNTED = frozenset(["webs.json"])
# Readers find the lists of a run by these, so they are put in place last.
LAST = ("webs.json", "_graph.json")
_ROWS = "folder string, file string, section string, body string, twin string"
SLICE_ROWS = 512
# Lines of a list go on in compressed parts when a task has written so many bytes of them.
PLAIN_BYTES = 8 * 1024 * 1024


@dataclass
class Part:
    """A file that a task has staged for ``folder/file``; ``suffix`` says how it is compressed."""

    folder: str
    file: str
    number: int
    staged: str
    lines: int
    suffix: str = ""


@dataclass
class Staged(WriterCommitMessage):
    parts: list[Part]


class _Output:
    """One staged file: lines, or a document of sections."""

    def __init__(self, store: fs.FileSystem, part: Part) -> None:
        self.part, self.file = part, store.open_output_stream(part.staged, compression=None)
        self.stream = gzip.GzipFile(fileobj=self.file, mode="wb", compresslevel=5) if part.suffix else self.file
        self.section: str | None = None
        self.size = 0

    def lines(self, bodies: Sequence[str]) -> None:
        if bodies:
            data = ("\n".join(bodies) + "\n").encode()
            self.stream.write(data)
            self.part.lines += len(bodies)
            self.size += len(data)

    def entry(self, section: str, body: str | None) -> None:
        """Entries of a section come one after another; a null body only makes the section."""
        fresh = section != self.section
        if fresh:
            self.stream.write((("{" if self.section is None else "\n],") + f'"{section}": [').encode())
            self.section = section
            self.empty = True
        if body is not None:
            self.stream.write((("\n" if self.empty else ",\n") + body).encode())
            self.empty = False
            self.part.lines += 1

    def close(self) -> None:
        if self.section is not None:
            count = f', "count": {self.part.lines}' if self.part.file in COUNTED else ""
            self.stream.write(f"\n]{count}}}\n".encode())
        self.stream.close()
        self.file.close()


class ContractWriter(DataSourceArrowWriter):
    """Rows of ``folder, file, section, body, twin``, those of a file together and in order.

    A row without section is a line; ``twin`` is the line of the raw file beside the items, so both files have
    the same order. A row with a section is an entry of a JSON document. A task stages files of its
    own attempt, ``commit`` puts those of the successful attempts in place, ``abort`` removes all that was staged.
    Lines beyond ``PLAIN_BYTES`` go on in parts with the suffix ``.gz``; both files of a list are parted at the same item.
    """

    def __init__(self, root: str, overwrite: bool, plain_bytes: int = PLAIN_BYTES) -> None:
        self.root, self.overwrite, self.plain_bytes = root.rstrip("/"), overwrite, plain_bytes
        self.staging = f"{self.root}/_staging-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        from pyspark import TaskContext

        store, base = open_store(self.staging)
        context = TaskContext.get()
        own = f"{base}/{context.partitionId()}-{context.taskAttemptId()}"
        store.create_dir(own)
        parts: list[Part] = []
        place, outputs, suffix = None, {}, ""

        def output(folder: str, file: str) -> _Output:
            if file not in outputs:
                parts.append(Part(folder, file, context.partitionId(), f"{own}/{len(parts)}", 0, suffix))
                outputs[file] = _Output(store, parts[-1])
            return outputs[file]

        def close() -> None:
            for o in outputs.values():
                o.close()
            outputs.clear()

        try:
            for batch in iterator:
                for start in range(0, batch.num_rows, SLICE_ROWS):
                    rows = batch.slice(start, SLICE_ROWS).to_pylist()
                    a = 0
                    while a < len(rows):
                        first, b = (rows[a]["folder"], rows[a]["file"]), a
                        while b < len(rows) and (rows[b]["folder"], rows[b]["file"]) == first:
                            b += 1
                        if first != place:
                            close()
                            place, suffix = first, ""
                        some, a = rows[a:b], b
                        if some[0]["section"] is not None:
                            for r in some:
                                output(*first).entry(r["section"], r["body"])
                            continue
                        output(*first).lines([r["body"] for r in some if r["body"] is not None])
                        if first[1] == ITEMS:
                            output(first[0], RAW).lines([r["twin"] for r in some if r["body"] is not None])
                        if not suffix and max(o.size for o in outputs.values()) > self.plain_bytes:
                            close()
                            suffix = ".gz"
        finally:
            close()
        return Staged(parts)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, base = open_store(self.root)
        files: dict[tuple[str, str], list[Part]] = {}
        for message in messages:
            for part in message.parts if message else ():
                files.setdefault((part.folder, part.file), []).append(part)
        for folder, file in sorted(files, key=lambda f: (f[1] in LAST, f)):
            # A part without lines says that the file must be there; it is needed where there is no other. A task's own are in order.
            parts = sorted(files[folder, file], key=lambda p: p.number)
            parts = [p for p in parts if p.lines] or parts[:1]
            self._place(store, f"{base}/{folder}/{file}" if folder else f"{base}/{file}", parts)
        self._drop_staging()

    def _place(self, store: fs.FileSystem, target: str, parts: list[Part]) -> None:
        """One part becomes the file itself; several become parts of a folder of that name, in order."""
        kind = store.get_file_info(target).type
        kept = 0
        if not self.overwrite and kind != fs.FileType.NotFound and not parts[0].lines:
            return
        if self.overwrite or len(parts) == 1 and kind == fs.FileType.NotFound:
            if kind == fs.FileType.Directory:
                store.delete_dir(target)
            elif kind == fs.FileType.File:
                store.delete_file(target)
        elif kind == fs.FileType.File:
            store.move(target, f"{target}.first")
            store.create_dir(target)
            store.move(f"{target}.first", f"{target}/part-{0:08d}")
            kept = 1
        elif kind == fs.FileType.Directory:
            kept = 1 + max(int(re.search(r"part-(\d+)[^/]*$", f.path)[1]) for f in store.get_file_info(fs.FileSelector(target)))
        store.create_dir(target.rpartition("/")[0])
        if len(parts) == 1 and not kept:
            store.move(parts[0].staged, target)
            return
        store.create_dir(target)
        for i, part in enumerate(parts, kept):
            if part.lines:
                store.move(part.staged, f"{target}/part-{i:08d}{part.suffix}")

    def _drop_staging(self) -> None:
        store, path = open_store(self.staging)
        if store.get_file_info(path).type == fs.FileType.Directory:
            store.delete_dir(path)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._drop_staging()


class ContractSource(DataSource):
    """``df.write.format("contract_landing").mode("overwrite" or "append").save(root)``."""

    @classmethod
    def name(cls) -> str:
        return "contract_landing"

    def schema(self) -> str:
        return _ROWS

    def writer(self, schema: object, overwrite: bool) -> ContractWriter:
        return ContractWriter(self.options["path"], overwrite, int(self.options.get("plainBytes", PLAIN_BYTES)))


_KEEP = {"ignoreNullFields": "false"}
FILE = ("filename", "url", "local_path", "bytes", "sha256", "downloaded", "skip_reason")


def _folder(web_url: Column, guid: Column) -> Column:
    return F.concat(F.lit("webs/"), names.web_slug(web_url), F.lit("/lists/"), names.guid_slug(guid))


def _row(folder: Column, file: str, section: str | None, body: Column, twin: Column | None = None) -> list[Column]:
    text = F.lit(None).cast("string")
    return [folder.alias("folder"), F.lit(file).alias("file"), F.lit(section).cast("string").alias("section"), body.alias("body"), (text if twin is None else twin).alias("twin")]


def with_attachments(items: DataFrame, attachments: DataFrame | None) -> DataFrame:
    """``items`` with the files of each as the array that the contract's lines carry, by url and name; none is ``[]``.

    Files that carry the ``item_id`` of their item beside its list are tied by both, as the items are dealt; others by ``doc_id``.
    """
    none = F.array().cast("array<struct<filename:string,url:string,local_path:string,bytes:bigint,sha256:string,downloaded:boolean,skip_reason:string>>")
    if attachments is None:
        return items.withColumn("attachments", none)
    entry = F.struct(*FILE)
    keys = ["item_id", "list_guid"] if "item_id" in attachments.columns else ["doc_id"]
    grouped = attachments.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("url", "filename", entry.alias("f")))).alias("_f"))
    joined = items.join(grouped.select(*keys, F.col("_f.f").alias("attachments")), keys, "left")
    rest = [c for c in items.columns if c != "doc_id"]
    return joined.select("doc_id", *rest, F.coalesce("attachments", none).alias("attachments"))


def _list_info(lists: DataFrame) -> Column:
    return F.struct(*[c for c in lists.columns if c != "raw_attributes"])


def _documents(lists: DataFrame, list_fields: DataFrame, webs: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``list.json`` and ``web.json`` documents, and the entries of ``webs.json`` and ``_graph.json`` in order."""
    columns = [c for c in list_fields.columns if c not in ("list_guid", "raw_attributes", "pos")]
    grouped = list_fields.groupBy(F.col("list_guid").alias("guid")).agg(F.array_sort(F.collect_list(F.struct("pos", F.struct(*columns).alias("f")))).alias("_f"))
    shaped = lists.join(grouped, "guid", "left").select("guid", "web_url", _list_info(lists).alias("list_info"), F.coalesce(F.col("_f.f"), F.array()).alias("fields"))
    order = F.lit("")
    out = shaped.select(*_row(_folder(F.col("web_url"), F.col("guid")), "list.json", None, F.to_json(F.struct("list_info", "fields"), _KEEP)), order.alias("_o"))
    owned = lists.groupBy(names.normalise_url(F.col("web_url")).alias("url")).agg(F.array_sort(F.collect_list(F.struct("guid", _list_info(lists).alias("l")))).alias("_l"))
    every = webs.select("url", "title", "web_id").join(owned, "url", "left").withColumn("slug", names.web_slug(F.col("url")))
    known = F.coalesce(F.col("_l.l"), F.array())
    entry = F.to_json(F.struct("web_id", "title", "url", "slug", F.size(known).alias("list_count"), known.alias("lists")), _KEEP)
    out = out.unionByName(every.select(*_row(F.concat(F.lit("webs/"), F.col("slug")), "web.json", None, entry), order.alias("_o")))
    out = out.unionByName(every.select(*_row(F.lit(""), "webs.json", "webs", entry), F.col("url").alias("_o")))
    node, edge = (F.to_json(F.struct(*df.columns), _KEEP) for df in (nodes, edges))
    out = out.unionByName(nodes.select(*_row(F.lit(""), "_graph.json", "nodes", node), F.col("list_guid").alias("_o")))
    out = out.unionByName(edges.select(*_row(F.lit(""), "_graph.json", "edges", edge), F.concat_ws(" ", "source_list_guid", "field_name").alias("_o")))
    # An empty section is still a section.
    spark = lists.sparkSession
    bare = spark.createDataFrame([("", "webs.json", "webs"), ("", "_graph.json", "nodes"), ("", "_graph.json", "edges")], "folder string, file string, section string")
    bare = bare.select("folder", "file", "section", *[F.lit(None).cast("string").alias(c) for c in ("body", "twin")], F.lit("").alias("_o"))
    # ``nodes`` stand in front of ``edges``.
    ordered = out.unionByName(bare).repartition("folder", "file").sortWithinPartitions("folder", "file", F.desc("section"), "_o", F.col("body").asc_nulls_first())
    return ordered.drop("_o")


def _lines(items: DataFrame, lists: DataFrame, attachments: DataFrame | None) -> DataFrame:
    """Line pairs of all items by list and item id, and a row for each list that makes its files."""
    whole = with_attachments(items, attachments)
    body = F.to_json(F.struct(*[c for c in whole.columns if c != "raw"]), _KEEP)
    folder = F.concat(F.lit("webs/"), F.col("web_slug"), F.lit("/lists/"), F.col("list_slug"))
    lines = add_slugs(whole, lists).select(*_row(folder, ITEMS, None, body, F.to_json("raw", _KEEP)), F.col("item_id").alias("_o"))
    present = lists.select(*_row(_folder(F.col("web_url"), F.col("guid")), ITEMS, None, F.lit(None).cast("string")), F.lit(None).cast("bigint").alias("_o"))
    order = [F.col("folder"), F.col("_o").asc_nulls_first()]
    # Stored, because the ranges are drawn from a first pass over the rows, which would else derive all of them.
    lines = store(lines, "lines", "zstd")
    return lines.unionByName(present).repartitionByRange(*order).sortWithinPartitions(*order).drop("_o")


def _save(rows: DataFrame, root: str, mode: str = "overwrite") -> None:
    rows.sparkSession.dataSource.register(ContractSource)
    rows.write.format(ContractSource.name()).mode(mode).save(root)


def write_contract_documents(lists: DataFrame, list_fields: DataFrame, webs: DataFrame, nodes: DataFrame, edges: DataFrame, root: str) -> None:
    """``list.json`` of every list, ``web.json`` of every web, ``webs.json`` and ``_graph.json``; item files stay as they are."""
    _save(_documents(lists, list_fields, webs, nodes, edges), root)


def write_contract_landing(
    items: DataFrame, lists: DataFrame, list_fields: DataFrame, webs: DataFrame, nodes: DataFrame, edges: DataFrame, root: str,
    attachments: DataFrame | None = None, resume: bool = False,
) -> None:
    """Lay out ``webs/{web}/lists/{list}/{list.json, items.jsonl, items_raw.jsonl}``, ``web.json``, ``webs.json`` and ``_graph.json``.

    ``items`` has the contract's columns and ``raw``, the attributes of the row without prefixes: a raw line is
    that one object. Both lines of an item are written by the same task at the same place, so no item is in one file only. Lists
    of the run are replaced, or with ``resume`` continued; a list without items has empty files. Rows are dealt out by ranges of
    list and item id: a huge list is written by many tasks, and its file is then a folder of parts in order, which Spark reads
    under the same path. Nothing is put in place before all tasks have succeeded.
    """
    require_utc(items.sparkSession)
    lines, documents = _lines(items, lists, attachments), _documents(lists, list_fields, webs, nodes, edges)
    if resume:
        # Documents always replace those before; only lines are continued.
        _save(lines, root, "append")
        _save(documents, root)
    else:
        _save(lines.unionByName(documents), root)
