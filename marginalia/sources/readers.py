"""Inputs: file listings, texts, sheets, and the JSON side files of a corpus."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.patterns import BASE_REPORTS
from ..functions.text import strip
from .sinks import filesystem

# Keys of a ledger that are not target paths.
LEDGER_KEYS = ("version", "created_at", "updated_at", "model", "mappings", "categories", "history")


def _name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Recursive listing (path, size_bytes, modified); the contents are never read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
        .select("path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified"))
    )


def scan_files(listing: DataFrame, extensions: Sequence[str]) -> DataFrame:
    """Files of the wanted kinds, lock files left out, each path once."""
    ext = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    return (
        listing.filter(ext.isin(*[e.lower() for e in extensions]) & ~_name(F.col("path")).startswith("~$"))
        .select("path").dropDuplicates(["path"])
    )


def scan_subset(listing: DataFrame, wanted: DataFrame, extensions: Sequence[str]) -> DataFrame:
    """Only listed files that exist; ``wanted(value)`` are the lines of a list file."""
    names = wanted.select(strip(F.col("value")).alias("path")).filter("path <> ''")
    return scan_files(listing, extensions).join(names, "path", "left_semi")


#: Files that a task reads, and bytes of text that it holds.
READ, HELD = 2_000, 8 << 20


def _listing(folder: str):
    """Entries of folders below ``folder``; names that open with a dot or a low line are hidden, as for Spark's sources."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        files, root = filesystem(folder)
        for batch in batches:
            for path in batch["path"]:
                inside = f"{root}/{path}" if path else root
                found = [(f"{path}/{i.base_name}" if path else i.base_name, i.type == fs.FileType.Directory) for i in files.get_file_info(
                    fs.FileSelector(inside)) if not i.base_name.startswith((".", "_"))]
                for at in range(0, len(found), 10_000):
                    yield pd.DataFrame(found[at:at + 10_000], columns=["path", "is_folder"])

    return run


def _reading(folder: str):
    def run(batches: Iterator) -> Iterator:
        from pyarrow import RecordBatch

        files, root = filesystem(folder)
        paths, texts, size = [], [], 0
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with files.open_input_stream(f"{root}/{path}") as source:
                    text = source.read()
                paths.append(path)
                texts.append(text.decode("utf-8", "replace"))
                size += len(text)
                if size >= HELD:
                    yield RecordBatch.from_pydict({"path": paths, "text": texts})
                    paths, texts, size = [], [], 0
        if paths:
            yield RecordBatch.from_pydict({"path": paths, "text": texts})

    return run


def whole_texts(spark: SparkSession, folder: str, suffix: str = "") -> DataFrame:
    """``path, text`` of all files below ``folder`` whose name ends in ``suffix``, empty ones too; ``path`` is below ``folder``.

    For very many small files: folders are listed by tasks, a level at a time, and a task opens
    its files one after the other, where Spark's source opens a reader and a checksum for each.
    A filesystem that Arrow does not know is read by Spark's source, which gives full paths.
    """
    try:
        filesystem(folder)
    except ValueError:
        return spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter=f"*{suffix}").select(
            F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    found = spark.createDataFrame([("", True)], "path string, is_folder boolean")
    files, n = None, 0
    while n_folders := found.filter("is_folder").count():
        found = found.filter("is_folder").repartition(n_folders if n_folders < 10_000 else 10_000, "path").mapInPandas(
            _listing(folder), "path string, is_folder boolean").checkpoint()
        level = found.filter(~F.col("is_folder") & F.col("path").endswith(suffix)).select("path")
        files, n = level if files is None else files.unionByName(level), n + level.count()
    return files.repartition(max(1, -(-n // READ)), "path").mapInArrow(_reading(folder), "path string, text string")


def scan_text_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """Whole ``*.txt`` files with their path below the folder."""
    return whole_texts(spark, folder, ".txt")


def scan_knowledge_base(docs: DataFrame, path: str = "path", skip_drafts: bool = True) -> DataFrame:
    """Markdown files of a base without its reports; ``category`` is the folder, NULL at the root."""
    p = F.col(path)
    keep = F.lower(p).endswith(".md") & ~_name(p).isin(*BASE_REPORTS) & ~_name(p).startswith("00_")
    if skip_drafts:
        keep = keep & ~p.contains("PR/")
    folder = F.when(p.contains("/"), F.element_at(F.split(p, "/"), -2))
    return docs.filter(keep).withColumn("category", folder)


def read_csv_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, inferSchema=True)


def ocr_manifest_paths(texts: DataFrame) -> DataFrame:
    """Distinct paths of ``{files: [{path} or str]}`` or of a bare list; unreadable text gives none."""
    items = F.coalesce(
        F.from_json("json", "struct<files:array<string>>")["files"], F.from_json("json", "array<string>"))
    item = F.col("item")
    path = F.when(item.startswith("{"), F.get_json_object(item, "$.path")).otherwise(item)
    return texts.select(F.explode(items).alias("item")).select(path.alias("path")).filter(
        "path IS NOT NULL").distinct()


def failed_files(texts: DataFrame) -> DataFrame:
    """Distinct files of ``failed_files`` in results JSON."""
    parsed = F.from_json("json", "struct<failed_files:array<struct<file:string,error:string,category:string>>>")
    return texts.select(F.inline(parsed["failed_files"])).select(F.col("file").alias("path")).filter(
        "path IS NOT NULL AND path <> ''").distinct()


def json_originals(texts: DataFrame) -> DataFrame:
    """Original file of each JSON record: the extension is added unless it is there."""
    r = F.from_json("json", "struct<original_path:string,file_format:string>")
    rows = texts.select(r["original_path"].alias("p"), F.lower(F.regexp_replace(r["file_format"], r"^\.+|\.+$", "")).alias("e"))
    ext = F.concat(F.lit("."), F.col("e"))
    return rows.filter("p <> '' AND e <> ''").select(
        F.when(F.lower("p").endswith(ext), F.col("p")).otherwise(F.concat("p", ext)).alias("path")).distinct()


def ledger_entries(texts: DataFrame) -> DataFrame:
    """(source, target, pos) of both ledger layouts; ``pos`` keeps the order within one ledger."""
    listed = texts.select(F.posexplode(F.from_json(
        "json", "struct<mappings:array<struct<id:string,input:array<string>,output:struct<path:string>>>>")["mappings"]
    ).alias("m_pos", "m")).select(
        "m_pos", F.coalesce("m.output.path", F.lit("")).alias("target"), F.posexplode("m.input").alias("i_pos", "i"))
    item = F.col("i")
    by_list = listed.select(
        F.when(item.startswith("{"), F.get_json_object(item, "$.file")).otherwise(item).alias("source"), "target",
        F.struct(F.lit(0).alias("layout"), "m_pos", "i_pos").alias("pos"))
    keyed = texts.select(F.posexplode(F.from_json("json", "map<string,string>")).alias("m_pos", "target", "v")).filter(
        ~F.col("target").isin(*LEDGER_KEYS) & F.col("v").startswith("{")
    ).select("m_pos", "target", F.posexplode(
        F.from_json("v", "struct<inputs:array<string>>")["inputs"]).alias("i_pos", "source"))
    by_key = keyed.select("source", "target", F.struct(F.lit(1).alias("layout"), "m_pos", "i_pos").alias("pos"))
    return by_list.unionByName(by_key).filter("source IS NOT NULL")


def _parsed(texts: DataFrame, schema: str) -> DataFrame:
    """The fields of each JSON text.  The text is parsed here, once; an expression beside an explode
    would parse it again for each row that comes out."""
    return texts.select(F.explode(F.array(F.from_json("json", schema))).alias("r")).select("r.*")


def term_entries(texts: DataFrame) -> DataFrame:
    """Terms of each document's JSON; unreadable files give no rows."""
    parsed = _parsed(texts, "struct<document_name:string,terms:array<struct<term:string,description:string,flag:int>>>")
    return parsed.select(F.col("document_name").alias("name"), F.posexplode("terms").alias("pos", "t")).select(
        "name", "pos", "t.*")


def chapter_summary_entries(texts: DataFrame) -> DataFrame:
    parsed = _parsed(
        texts, "struct<document_name:string,chapters:array<struct<title:string,summary:array<string>,line_start:int,line_end:int>>>")
    return parsed.select(F.col("document_name").alias("name"), F.posexplode("chapters").alias("pos", "c")).select(
        "name", "pos", "c.*")


def manifest_pages(texts: DataFrame) -> DataFrame:
    """Pages of a nested page manifest, with section name and both positions."""
    parsed = F.from_json(
        "json", "struct<sections:array<struct<name:string,index:int,pages:array<struct<title:string,deep_link:string,"
        "page_guid:string,section_guid:string,status:string,pdf_path:string,error:string>>>>>")
    sections = texts.select(F.posexplode(parsed["sections"]).alias("section_pos", "s"))
    return sections.select("section_pos", F.col("s.name").alias("section"), F.posexplode("s.pages").alias("page_pos", "p")).select(
        "section_pos", "section", "page_pos", "p.*")
