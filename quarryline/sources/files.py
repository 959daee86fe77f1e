"""Loading files, listing files, and their statistics."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarryline.functions.checksums import all_checksums
from quarryline.functions.dates import quoted
from quarryline.functions.text import base_name
from quarryline.operators.columns import union_tables
from quarryline.runtime import expand_glob, scratch_path, ship_package, task_filesystem
from quarryline.sources.csv_tables import load_csv
from quarryline.sources.formats import SOURCE_FILE_COLUMN, file_format, worksheet
from quarryline.sources.pickled import read_pickled
from quarryline.sources.workbook import read_workbooks

# Bigger files are hashed as a stream instead of being held as one value.
WHOLE_FILE_LIMIT = 256 * 1024 * 1024

_STREAM_BLOCK = 8 * 1024 * 1024

JSON_LAYOUTS = ("auto", "lines", "records", "columns")


def build_file_list(spark: SparkSession, pattern: str) -> list[str]:
    """The paths a glob stands for; an unknown folder gives none."""
    return [entry.path for entry in expand_glob(spark, pattern)]


def _glob_regex(pattern: str) -> str:
    """A file name glob as a regular expression."""
    parts = {"*": ".*", "?": ".", "{": "(?:", "}": ")", ",": "|"}
    return "".join(parts.get(c, c if c in "[]-^" or c.isalnum() else re.escape(c)) for c in pattern)


def _empty_files(
    spark: SparkSession, paths: list[str], pattern: str | None, recursive: bool
) -> DataFrame:
    """The files without content, which Spark's file sources pass over; folders are listed by tasks."""
    roots = [(e.path, e.is_dir) for path in paths for e in expand_glob(spark, path)]
    wanted = re.compile(_glob_regex(pattern or "*"))

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for batch in batches:
            rows = []
            for root, is_dir in zip(batch["root"], batch["is_dir"]):
                filesystem, location = task_filesystem(root)
                what = fs.FileSelector(location, recursive=recursive) if is_dir else [location]
                for info in filesystem.get_file_info(what):
                    below = info.path[len(location) :]
                    hidden = any(part.startswith(("_", ".")) for part in below.split("/"))
                    if info.type == fs.FileType.File and info.size == 0 and not hidden:
                        if wanted.fullmatch(info.base_name):
                            rows.append((root + below, info.mtime))
            yield pd.DataFrame(rows, columns=["path", "modificationTime"])

    ship_package(spark)
    folders = spark.createDataFrame(roots, "root string, is_dir boolean")
    found = folders.mapInPandas(listed, "path string, modificationTime timestamp")
    return found.withColumns({"length": F.lit(0).cast("long"), "content": F.lit("").cast("binary")})


def _file_table(
    spark: SparkSession, paths: str | list[str], pattern: str | None, recursive: bool
) -> DataFrame:
    """Files with their content as a lazy column; files without content included."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(paths).unionByName(_empty_files(spark, paths, pattern, recursive))


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Files of a folder as a table: path, modificationTime, length. Contents are not read.

    A folder that does not exist has no files.
    """
    if not expand_glob(spark, folder):
        return spark.createDataFrame([], "path string, modificationTime timestamp, length long")
    return _file_table(spark, folder, pattern, False).select("path", "modificationTime", "length")


def read_text_document(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as one text each."""
    return spark.read.text(path, wholetext=True)


def read_json_document(spark: SparkSession, path: str) -> DataFrame:
    """Whole JSON documents as one variant each: lists, objects and texts may mix."""
    return read_text_document(spark, path).select(F.parse_json("value").alias("document"))


def _with_provenance(df: DataFrame) -> DataFrame:
    return df.withColumn(SOURCE_FILE_COLUMN, F.col("_metadata.file_name"))


def _is_columns(document) -> bool | None:
    """Whether a document holds rows below columns; None when it could also be one record."""
    cells = list(document.values()) if isinstance(document, dict) else []
    if not cells or not all(isinstance(cell, dict) for cell in cells):
        return False
    keys = {key for cell in cells for key in cell}
    return all(re.fullmatch("[0-9]+", key) for key in keys) if keys else None


# A document on one line whose values are objects below numbers: rows below columns, or one record of such objects. Several
# values with the same numbers are columns. Otherwise numbers that count from 0 are rows unless other files are lines.
UNCLEAR = ("columns or record", "numbers or record")


def _one_line(document: dict) -> str:
    rows = {frozenset(cell) for cell in document.values()}
    if len(document) > 1 and len(rows) == 1:
        return "columns"
    keys = {int(key) for row in rows for key in row}
    return UNCLEAR[0] if keys == set(range(len(keys))) else UNCLEAR[1]


def json_layout(stream) -> str:
    """Layout of one JSON file: lines, records or columns; empty for a file without content, else what is wrong or unclear.

    The first document decides as far as it is on a line of its own with more below it. A file of one document is held
    whole, as Spark's reader holds it.
    """
    first, at_end = b"", False
    while not first.strip() and not at_end:
        first, at_end = _next_line(stream)
    first = first.decode("utf-8-sig").strip()
    if not first:
        return ""
    try:
        document, whole = json.loads(first), True
    except ValueError:
        document, whole = None, False
    more = b""
    while not more.strip() and not at_end:
        more, at_end = _next_line(stream)
    more = bool(more.strip())
    if first.startswith("["):
        return "starts with a list that ends before the file does" if whole and more else "records"
    if not first.startswith("{"):
        return "starts with neither a list nor an object"
    if whole and more:
        return "lines"
    if not whole:
        stream.seek(0)
        try:
            document = json.loads(stream.read().decode("utf-8-sig"))
        except ValueError:
            return "is neither lines of objects nor one document"
    columns = _is_columns(document)
    if columns is None:
        return "may be columns without rows or one record of empty objects"
    if columns and whole:
        return _one_line(document)
    return "columns" if columns else "lines" if whole else "records"


def _next_line(stream) -> tuple[bytes, bool]:
    line = stream.readline()
    return line, not line


def _json_groups(spark: SparkSession, paths: list[str], spec: Mapping) -> dict[str, list[str]]:
    """The paths by layout; as given when all files share one. Each task reads its files as far as they need."""
    layout = spec.get("layout", "auto")
    if layout not in JSON_LAYOUTS:
        raise ValueError(f"JSON layout must be one of {JSON_LAYOUTS}, not {layout!r}")
    if layout != "auto":
        return {layout: paths}

    def layouts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io

        for batch in batches:
            found = []
            for path in batch["path"]:
                filesystem, location = task_filesystem(path)

                def opened(filesystem=filesystem, location=location):
                    return filesystem.open_input_stream(location, compression="detect")

                with _Reopened(opened, io.BufferedReader) as stream:
                    found.append(json_layout(stream))
            yield pd.DataFrame({"path": batch["path"], "layout": found})

    ship_package(spark)
    listed = spark.read.format("binaryFile").load(paths).select("path")
    known = scratch_path(spark, "layouts")
    listed.mapInPandas(layouts, "path string, layout string").where("layout <> ''").write.parquet(known)
    found = spark.read.schema("path string, layout string").parquet(known)
    kinds = {r.layout for r in found.select("layout").distinct().collect()}
    clear = kinds & set(JSON_LAYOUTS)
    # What one line leaves open, the other files decide.
    decided = next((kind for kind in ("columns", "lines") if kind in clear), None)
    meant = {UNCLEAR[0]: decided or "columns", UNCLEAR[1]: decided} if not clear or decided else dict.fromkeys(UNCLEAR)
    wrong = sorted(kind for kind in kinds - clear if meant.get(kind) is None)
    if wrong:
        path, why = found.where(F.col("layout") == wrong[0]).first()
        why = "may be columns of numbered rows or one record of objects" if why in UNCLEAR else f"it {why}"
        raise ValueError(f"the layout of JSON file {path} is not clear, {why}; give a layout for it")
    kinds = {meant.get(kind, kind) for kind in kinds}
    if len(kinds) <= 1:
        return {(kinds or {"lines"}).pop(): paths}
    groups: dict[str, list[str]] = {}
    for path, kind in sorted(found.collect()):
        groups.setdefault(meant.get(kind, kind), []).append(path)
    return groups


class _Reopened:
    """A stream that only goes forward, but can start again."""

    def __init__(self, opened, buffered):
        self.opened, self.buffered = opened, buffered
        self.seek(0)

    def seek(self, _: int) -> None:
        self.stream = self.buffered(self.opened())
        self.readline, self.read = self.stream.readline, self.stream.read

    def __enter__(self):
        return self

    def __exit__(self, *_) -> None:
        self.stream.close()


def _load_json_columns(spark: SparkSession, paths: list[str], schema: StructType | None = None) -> DataFrame:
    """Documents of the form ``{"column": {"row": value}}``.

    A document is a map of columns, each a map of rows. Where all columns of a document have the same rows in one order, as
    documents written from tables do, the columns are zipped in place; cells of other documents are exploded and
    brought together per file and row. Column types come from the schema, or from one aggregation over the cells.
    """
    documents = spark.read.text(paths, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_name").alias("source"),
        F.from_json("value", "map<string,map<string,variant>>").alias("document"),
    )
    columns = documents.select("file", F.explode("document").alias("name", "rows"))
    cells = columns.select("file", "name", F.explode("rows").alias("row", "cell"))
    if schema is not None:
        found = {field.name: field.dataType.simpleString() for field in schema}
    else:
        kinds = cells.groupBy("name").agg(
            F.expr("schema_of_variant_agg(cell)").alias("kind"), F.min("file").alias("f")
        )
        found = {r.name: _cell_type(r.kind) for r in kinds.orderBy("f", "name").collect()}
    rows = F.transform(F.map_values("document"), lambda cells: F.map_keys(cells))
    alike = F.coalesce(F.size(F.array_distinct(rows)) == 1, F.lit(False))
    # The rows of a column, where a document has it; zipping adds nulls where it has not.
    own = [F.map_values(F.try_element_at("document", F.lit(name))).alias(f"c{i}") for i, name in enumerate(found)]
    first = F.map_keys(F.get(F.map_values("document"), F.lit(0))).alias("row")
    zipped = documents.where(alike).select("source", F.inline(F.arrays_zip(first, *(F.coalesce(c, F.array()).alias(f"c{i}") for i, c in enumerate(own)))))
    straight = zipped.select(
        *[F.try_variant_get(f"c{i}", "$", kind).alias(name) for i, (name, kind) in enumerate(found.items())],
        F.col("source").alias(SOURCE_FILE_COLUMN),
    )
    values = [
        F.any_value(F.when(F.col("name") == name, F.try_variant_get("cell", "$", kind)), True).alias(name)
        for name, kind in found.items()
    ]
    apart = documents.where(~alike).select("file", "source", F.explode("document").alias("name", "rows"))
    apart = apart.select("file", "source", "name", F.explode("rows").alias("row", "cell"))
    regrouped = (
        apart.groupBy("file", "source", "row").agg(*values).drop("file", "row")
        .select(*[quoted(n) for n in found], F.col("source").alias(SOURCE_FILE_COLUMN))
    )
    return straight.unionByName(regrouped)


def _cell_type(kind: str) -> str:
    """A plain column type for what a column of cells holds."""
    if kind.startswith("DECIMAL"):
        return "double"
    return "string" if kind.startswith(("VOID", "VARIANT", "OBJECT", "ARRAY")) else kind


def _load_json(spark: SparkSession, paths: list[str], spec: Mapping) -> DataFrame:
    schema = spec.get("schema")
    if schema is not None and not isinstance(schema, StructType):
        schema = spark.createDataFrame([], schema).schema
    parts = []
    for layout, group in _json_groups(spark, paths, spec).items():
        if layout == "columns":
            parts.append(_load_json_columns(spark, group, schema))
            continue
        reader = spark.read.option("multiLine", layout == "records")
        parts.append(_with_provenance((reader if schema is None else reader.schema(schema)).json(group)))
    return parts[0] if len(parts) == 1 else union_tables(parts)


def _load_parquet(spark: SparkSession, paths: list[str], spec: Mapping) -> DataFrame:
    if spec.get("schema") is not None:
        return _with_provenance(spark.read.schema(spec["schema"]).parquet(*paths))
    try:
        return _with_provenance(spark.read.option("mergeSchema", True).parquet(*paths))
    except (PySparkException, Py4JJavaError):
        # Types that differ between outputs are brought together column by column.
        if len(paths) == 1:
            raise
        return union_tables([_load_parquet(spark, [path], spec) for path in paths])


def load(spark: SparkSession, spec: Mapping) -> DataFrame:
    """Load files into one table, by name, with the source file of every row.

    ``spec``: ``format`` (csv, excel, json, parquet, pickle), ``file list`` (paths, globs or
    output folders), and optionally ``field delimiter``, ``worksheet list``, ``layout`` (JSON) and
    ``schema``, which saves the inference pass.
    """
    chosen = file_format(spec)
    given = spec.get("file list", spec.get("name"))
    paths = [given] if isinstance(given, str) else list(given or [])
    if not paths:
        raise ValueError('a load specification needs a non-empty "file list"')
    if chosen == "csv":
        return load_csv(spark, paths, spec)
    if chosen == "excel":
        return read_workbooks(spark, paths, worksheet(spec), spec.get("schema"))
    if chosen == "json":
        return _load_json(spark, paths, spec)
    if chosen == "parquet":
        return _load_parquet(spark, paths, spec)
    return read_pickled(spark, paths)


def ingest(spark: SparkSession, pattern: str, spec: Mapping) -> DataFrame:
    """All files matching a glob, loaded by format and united with provenance."""
    return load(spark, {**spec, "file list": [pattern]})


def _stream_checksums(files: DataFrame) -> DataFrame:
    """Checksums of big files: read block by block in the tasks, whatever the size."""

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        names = ("md5", "sha1", "sha224", "sha256", "sha384", "sha512")
        for batch in batches:
            rows = []
            for path in batch["path"]:
                hashes = [hashlib.new(n) for n in names]
                filesystem, location = task_filesystem(path)
                with filesystem.open_input_stream(location, compression=None) as stream:
                    while block := stream.read(_STREAM_BLOCK):
                        for h in hashes:
                            h.update(block)
                rows.append([h.hexdigest() for h in hashes])
            labels = ["MD5", "SHA1", "SHA224", "SHA256", "SHA384", "SHA512"]
            out = pd.DataFrame(rows, columns=[f"{label} Checksum" for label in labels])
            yield pd.concat([batch.reset_index(drop=True), out], axis=1)

    schema = StructType(list(files.schema.fields))
    for label in all_checksums(F.lit("")):
        schema = schema.add(label, "string")
    ship_package(files.sparkSession)
    return files.mapInPandas(digest, schema)


def file_statistics(
    spark: SparkSession,
    paths: str | list[str],
    checksum: bool = False,
    pattern: str | None = None,
    whole_file_limit: int = WHOLE_FILE_LIMIT,
) -> DataFrame:
    """One row per file: path, name, size, last change, and optionally all checksums.

    Without checksums the contents are not read. The length filters are pushed to the file
    source, so a file over the limit is never loaded as one value.
    """
    files = _file_table(spark, paths, pattern, True)
    facts = [
        F.col("path"),
        base_name("path").alias("file name"),
        F.col("length").alias("size [bytes]"),
        F.col("modificationTime").alias("date when last modified"),
    ]
    if not checksum:
        return files.select(*facts)
    digests = [column.alias(name) for name, column in all_checksums(F.col("content")).items()]
    whole = files.where(F.col("length") <= whole_file_limit).select(*facts, *digests)
    streamed = _stream_checksums(files.where(F.col("length") > whole_file_limit).select(*facts))
    return whole.unionByName(streamed)


def stale_file_report(
    spark: SparkSession, folder: str, expression: str, as_of, pattern: str = "*"
) -> DataFrame:
    """Every file of a folder with a verdict against a calculated date."""
    from quarryline.functions.calendar import barrier
    from quarryline.functions.dates import moment_literal
    from quarryline.operators.filters import add_age_verdict

    files = list_files(spark, folder, pattern).withColumn(
        "modificationTime", F.col("modificationTime").cast("timestamp_ntz")
    )
    limit = barrier(moment_literal(as_of), expression)
    return add_age_verdict(files.withColumn("barrier", limit), "modificationTime", F.col("barrier"))

