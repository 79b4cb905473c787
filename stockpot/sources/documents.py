"""Reading and writing catalogs of JSON documents, on any file system that Arrow knows."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Iterator
from pathlib import Path
from typing import Any
from urllib.parse import unquote

from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from stockpot.functions.ids import content_hash
from stockpot.types import DOCUMENT, INDEXES


def _place(path: str | Path) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a path and its place there; Hadoop writes local paths with one slash or three."""
    if re.match("file:/", str(path)):
        return arrow_fs.LocalFileSystem(), unquote(re.sub("^file:/+", "/", str(path)))
    return arrow_fs.FileSystem.from_uri(str(path)) if "://" in str(path) else (arrow_fs.LocalFileSystem(), str(Path(path).absolute()))


def exists(path: str | Path) -> bool:
    system, where = _place(path)
    return system.get_file_info(where).type == arrow_fs.FileType.File


def read_bytes(path: str | Path) -> bytes:
    system, where = _place(path)
    with system.open_input_stream(where) as stream:
        return stream.read()


def write_text(path: str | Path, pieces: Iterable[str]) -> None:
    """A file of some pieces of text, put in place at once when it is whole."""
    system, where = _place(path)
    system.create_dir(where.rpartition("/")[0], recursive=True)
    part = f"{where}.part-{uuid.uuid4().hex}"
    with system.open_output_stream(part) as stream:
        for piece in pieces:
            stream.write(piece.encode())
    system.move(part, where)


def read_documents(spark: SparkSession, folder: str, schema: str = DOCUMENT) -> DataFrame:
    """The JSON documents of a folder with path, their ordinal. A folder that is missing or empty gives no rows.

    Files that hold no object come out with the content in _corrupt_record and all else null.
    """
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(where) or not system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(where, "*.json")):
        return spark.createDataFrame([], f"{schema}, _corrupt_record string, path string")
    docs = spark.read.schema(f"{schema}, _corrupt_record string").option("multiLine", True).option("pathGlobFilter", "*.json").json(folder)
    return docs.withColumn("path", F.col("_metadata.file_path"))


def read_hashes(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    """path and the SHA-256 of each file's bytes."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", content_hash(F.col("content")).alias("file_sha256"))


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    """The URLs of a text file, one a line; what follows # and blank lines are dropped."""
    line = F.trim(F.split("value", "#")[0])
    return spark.read.text(path).select(line.alias("url")).where("url <> ''")


def documents_by_slug(docs: DataFrame) -> DataFrame:
    """One document a slug, of several the last by path."""
    rest = [c for c in docs.columns if c != "slug"]
    return docs.where("slug is not null").groupBy("slug").agg(F.max_by(F.struct(*rest), F.col("path")).alias("_d")).select("slug", "_d.*")


def read_index(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The rows of an index or review file: recipes, categories, tags, ingredients or entries. A missing file is an error.

    One file is read by one task; large catalogs are better kept as tables.
    """
    if not exists(path):
        raise FileNotFoundError(f"missing index file: {path}")
    return spark.read.schema(f"{name} array<struct<{INDEXES[name]}>>").option("multiLine", True).json(str(path)).select(F.inline(name))


def read_ingredient_index(spark: SparkSession, path: str) -> DataFrame:
    """The ingredients by id, of rows with one id the last; a missing file is an error."""
    rows = spark.read.schema(f"ingredients array<struct<{INDEXES['ingredients']}>>").option("multiLine", True).json(str(path)) if exists(path) else None
    if rows is None:
        raise FileNotFoundError(f"missing ingredient index: {path}")
    each = rows.select(F.posexplode("ingredients").alias("_p", "_x")).where("_x.id is not null")
    return each.groupBy("_x.id").agg(F.max_by("_x", "_p").alias("_l")).select("_l.*")


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """kind (reviewed or written), id and seq of a resume state; without the file no rows, a state without lists is an error."""
    payload = json.loads(read_bytes(path)) if exists(path) else {}
    lists = {kind: payload.get(f"{kind}_ids", []) for kind in ("reviewed", "written")}
    if not all(isinstance(ids, list) for ids in lists.values()):
        raise ValueError(f"invalid state file: {path}")
    return spark.createDataFrame([(kind, str(i), n) for kind, ids in lists.items() for n, i in enumerate(ids)], "kind string, id string, seq long")


def write_state(state: DataFrame, path: str) -> None:
    """A resume state as a JSON file, each id once in the order of its first seq."""
    once = state.groupBy("kind", "id").agg(F.min("seq").alias("seq")).orderBy("seq")
    ids = {kind: [r.id for r in once.where(F.col("kind") == kind).toLocalIterator()] for kind in ("reviewed", "written")}
    dump_json(path, {"reviewed_ids": ids["reviewed"], "written_ids": ids["written"]})


def write_url_list(urls: DataFrame, path: str, order: str = "url") -> None:
    """A text file of URLs, one a line, in the order of a column."""
    write_text(path, (f"{r.url}\n" for r in urls.orderBy(order).select("url").toLocalIterator()))


def _to_json(payload: Any) -> str:
    return json.dumps(payload, indent=2, ensure_ascii=True) + "\n"


def write_documents(docs: DataFrame, path: str, names: str = "_file") -> None:
    """One JSON file for each row, written by the executors: path/<the row's name>, or the name itself where path is empty.

    names: a column of file names, which is left out of the document; of rows with one name the
    last by revision is written. Each file is put in place at once, so a task that runs again does no harm.
    """
    body = [c for c in docs.columns if c != names]
    last = docs.where(F.col(names).isNotNull()).groupBy(names).agg(F.max_by(F.struct(*(F.col(f"`{c}`") for c in body)), F.coalesce("revision", F.lit(0)) if "revision" in body else F.lit(0)).alias("_d"))

    def write(rows: Iterator[Row]) -> None:
        for row in rows:
            write_text(f"{path.rstrip('/')}/{row[0]}" if path else row[0], [_to_json(row["_d"].asDict(recursive=True))])

    last.foreachPartition(write)


def rewrite_changed(changed: DataFrame, *helpers: str) -> int:
    """Writes the changed documents over the files they came from (column path) and returns their number; helper columns are left out."""
    docs = changed.drop("_corrupt_record", *helpers).withColumnRenamed("path", "_file")
    write_documents(docs, "")
    return docs.select("_file").distinct().count()


def dump_json(path: str | Path, payload: Any) -> None:
    """A small payload as a JSON file with indent 2, ASCII alone and a line end, put in place at once."""
    write_text(path, [_to_json(payload)])


def dump_rows(path: str | Path, header: dict[str, Any], name: str, rows: DataFrame, footer: dict[str, Any] | None = None) -> None:
    """A JSON file with the header's keys, the ordered rows as a list under name, and the footer's keys.

    The rows come to the driver partition by partition and are written as they come, so its
    memory does not grow with them. For large catalogs tables are the better sink.
    """
    indented = lambda value, by: json.dumps(value, indent=2, ensure_ascii=True).replace("\n", "\n" + " " * by)

    def pieces() -> Iterator[str]:
        yield "{\n" + "".join(f"  {json.dumps(k)}: {indented(v, 2)},\n" for k, v in header.items()) + f"  {json.dumps(name)}: ["
        first = True
        for row in rows.toLocalIterator(prefetchPartitions=True):
            yield ("\n    " if first else ",\n    ") + indented(row.asDict(recursive=True), 4)
            first = False
        yield ("]" if first else "\n  ]") + "".join(f",\n  {json.dumps(k)}: {indented(v, 2)}" for k, v in (footer or {}).items()) + "\n}\n"

    write_text(path, pieces())
