"""Readers of source trees, JSON lists, pages and lists, and a connector for paged remote sources.

Files are read by the built-in sources with their pruning; only what needs a decoder or an error position runs in
Arrow functions.  Rows that cannot be read go to a ``failed`` column or table, never away.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from siltloom.common import map_rows
from siltloom.functions.code import decode
from siltloom.functions.html import numbered

#: Folders that are pruned from a walk and those that hold UI sources.
PRUNED = ("build", "oh_modules")
UI_FOLDERS = ("pages", "component")


def source_files(spark: SparkSession, root: str, pattern: str = "*.ets", stream: bool = False) -> DataFrame:
    """(path, content, modificationTime, length) of all files below ``root`` that fit; the glob prunes before reading."""
    reader = spark.readStream if stream else spark.read
    reader = reader.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    if stream:
        reader = reader.schema("path string, modificationTime timestamp, length long, content binary")
    return reader.load(root)


def ui_sources(files: DataFrame) -> DataFrame:
    """Files of folders whose names begin like the UI folders, outside pruned folders."""
    outside = ~F.col("path").rlike("/(" + "|".join(PRUNED) + ")/")
    return files.where(outside & F.col("path").rlike("/main/ets/(" + "|".join(UI_FOLDERS) + ")"))


def layout_files(files: DataFrame) -> DataFrame:
    """XML layouts of the application module."""
    return files.where(F.col("path").rlike("/app/src/main/res/layout/[^/]+\\.xml$"))


def decoded(files: DataFrame) -> DataFrame:
    """(path, text): each file in the first of six encodings that fits."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for path, data in rows:
            yield path, decode(data)

    return map_rows(files.select("path", "content"), run, "path string, text string", block=256)


def tolerant_json(text: str | None):
    """(value, None), or (None, error): strict, else without the comma at the error's line, else without control characters."""
    if text is None:
        return None, "null"
    try:
        return json.loads(text), None
    except json.JSONDecodeError as e:
        error = e
    lines = text.split("\n")
    row = min(error.lineno, len(lines)) - 1
    for at in (row, row - 1):
        if 0 <= at < len(lines) and lines[at].rstrip().endswith(","):
            try:
                return json.loads("\n".join([*lines[:at], lines[at].rstrip()[:-1], *lines[at + 1 :]])), None
            except json.JSONDecodeError:
                pass
    try:
        return json.loads(re.sub(r",(\s*[}\]])", r"\1", re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "", text))), None
    except json.JSONDecodeError as e:
        return None, str(e)


def json_items(texts: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """(path, pos, item, failed): the elements of each file's JSON array as JSON texts; a single object counts as one.

    A file that cannot be read gives one row with a null item and the error.
    """

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for where, body in rows:
            value, error = tolerant_json(body)
            if error:
                yield where, 0, None, error
                continue
            for i, item in enumerate(value if isinstance(value, list) else [value]):
                yield where, i, json.dumps(item, ensure_ascii=False), None

    return map_rows(texts.select(path, text), run, "path string, pos int, item string, failed string")


def nested_items(texts: DataFrame) -> DataFrame:
    """Elements two levels below the top of each file's JSON; a file that cannot be read is one row with what failed."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for where, body in rows:
            value, error = tolerant_json(body)
            if error:
                yield where, 0, None, error
                continue
            n = 0
            for outer in value.values() if isinstance(value, dict) else value if isinstance(value, list) else []:
                for item in outer.values() if isinstance(outer, dict) else outer if isinstance(outer, list) else []:
                    yield where, n, json.dumps(item, ensure_ascii=False), None
                    n += 1

    return map_rows(texts.select("path", "text"), run, "path string, pos int, item string, failed string")


def repo_list(spark: SparkSession, path: str) -> DataFrame:
    """id, repo_name, repo_url, cloned of a comma list; lines from # on and blank lines are left out."""
    return spark.read.schema("id long, repo_name string, repo_url string, cloned int").option("comment", "#").csv(path)


def line_list(spark: SparkSession, path: str) -> DataFrame:
    """Lines without the blanks around them, blank ones left out."""
    from siltloom.common import strip_text

    return spark.read.text(path).select(strip_text(F.col("value")).alias("line")).where("line <> ''")


def html_pages(spark: SparkSession, root: str) -> DataFrame:
    """(file_path, html, id) of the pages below a folder, numbered in path order."""
    pages = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.html").select(F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("html"))
    return numbered(pages, ["file_path"])


def repositories_with(listing: DataFrame, extension: str = ".ets") -> DataFrame:
    """(repo, has): whether any path of the repository's tree ends so."""
    return listing.groupBy("repo").agg(F.bool_or(F.col("path").endswith(extension)).alias("has"))


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in range(int(self.options.get("pages", "1")))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        import importlib

        module, _, name = self.options["fetcher"].partition(":")
        fetch: Callable[[dict[str, str], int], list[tuple[str, str | None]]] = getattr(importlib.import_module(module), name)
        for key, text in fetch(self.options, partition.value):
            yield key, text


class RemotePages(DataSource):
    """(key, body) from a paged remote source; option ``fetcher`` names module:function, called per page with the options.

    A failed fetch gives a null body, which belongs into quarantine.  An empty page gives no rows.
    """

    @classmethod
    def name(cls) -> str:
        return "remote_pages"

    def schema(self) -> str:
        return "key string, body string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RemotePages)


def catalogue_leaves(tree: str | None) -> list[str]:
    """The documents of the leaves of a catalogue tree, depth first."""
    out: list[str] = []

    def walk(node) -> None:
        if isinstance(node, list):
            for child in node:
                walk(child)
        elif isinstance(node, dict):
            if node.get("isLeaf"):
                if node.get("relateDocument"):
                    out.append(node["relateDocument"])
            else:
                walk(node.get("children") or [])

    walk(json.loads(tree) if tree else [])
    return out


def image_column(pixels: Column, height: Column, width: Column) -> Column:
    """Pixel lists with their size as one struct, the form that the image functions take."""
    return F.struct(pixels.alias("pixels"), height.alias("height"), width.alias("width"))
