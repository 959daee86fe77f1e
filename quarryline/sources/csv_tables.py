"""CSV files as one table: any number of headers in one scan, and files that are split although fields go over line ends.

A header dictionary (file, header) is read from the heads of the files. One scan reads fields by position, and each
output column takes its field from where the header of the row's file has it.

Quoted fields may hold line ends. Then a part of a file cannot know whether it begins inside such a field. So every
split is first passed through once for both cases: what it does to "outside" and to "inside" is a function
of two values, and composing these functions in file order tells how each split begins. With that known, tasks cut their
splits into records; only records that go over a border between splits are brought together, by file and place.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quarryline.functions.dates import quoted
from quarryline.runtime import scratch_path, ship_package, task_filesystem
from quarryline.sources.formats import SOURCE_FILE_COLUMN, field_delimiter

# Texts that stand for a missing value in a CSV file, besides an empty field.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)

WHOLE_NUMBER = r"^\s*[+-]?\d+\s*$"
NUMBER = r"^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf|infinity))\s*$"
PLAIN_NUMBER = r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)\s*$"

# Digits of the widest exact number type.
WIDEST = 38

_FILE = "__file"
_HEAD_BLOCK = 65_536


def ends_inside(line: str, inside: bool, separator: str) -> bool:
    """Whether a line ends inside a quoted field; a quote opens a field only as its first character."""
    at = 0
    while True:
        if inside:
            quote = line.find('"', at)
            if quote < 0:
                return True
            at = quote + 1
            if line.startswith('"', at):
                at += 1
                continue
            inside = False
        elif line.startswith('"', at):
            inside, at = True, at + 1
            continue
        following = line.find(separator, at)
        if following < 0:
            return False
        at = following + len(separator)


def _headers(spark: SparkSession, paths: list[str], separator: str) -> DataFrame:
    """``path`` and ``header`` (the first record) of every file that has one; tasks read the heads of their files."""

    def heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for path in batch["path"]:
                filesystem, location = task_filesystem(path)
                with filesystem.open_input_stream(location, compression="detect") as stream:
                    found.append(_first_record(stream, separator))
            yield pd.DataFrame({"path": batch["path"], "header": found})

    ship_package(spark)
    listed = spark.read.format("binaryFile").load(paths).select(F.col("_metadata.file_path").alias("path"))
    return listed.mapInPandas(heads, "path string, header string").where("header <> ''")


def _first_record(stream, separator: str) -> str:
    """The first record that is not blank, as far as a file has one."""
    held, more = b"", True
    while True:
        *lines, rest = held.split(b"\n")
        record, inside = "", False
        for line in lines if more else [*lines, rest]:
            text = line.decode("utf-8-sig" if not record else "utf-8").rstrip("\r")
            if not record and not text.strip():
                continue
            record = f"{record}\n{text}" if inside else text
            inside = ends_inside(text, inside, separator)
            if not inside:
                return record
        if not more:
            return record
        block = stream.read(_HEAD_BLOCK)
        held, more = held + block, bool(block)


def column_names(header: str, separator: str) -> list[str]:
    """Names of a header as Spark's reader gives them: places for empty ones, and numbers behind repeated ones."""
    names = _fields(header, separator)
    folded = [name.lower() for name in names]
    return [f"_c{i}" if not name else f"{name}{i}" if folded.count(name.lower()) > 1 else name for i, name in enumerate(names)]


def _fields(record: str, separator: str) -> list[str]:
    """Fields of one record."""
    found, at = [], 0
    while True:
        quote = re.compile(r'"((?:[^"]|"")*)"').match(record, at)
        following = record.find(separator, quote.end() if quote else at)
        end = len(record) if following < 0 else following
        found.append(quote.group(1).replace('""', '"') if quote and quote.end() == end else record[at:end])
        if following < 0:
            return found
        at = following + len(separator)


def _closed(line: Column, separator: str) -> Column:
    """Whether every quoted field of a line ends in it."""
    sep = re.escape(separator)
    field = rf'(?:"(?:[^"]|"")*+"(?:(?!{sep}|").(?:(?!{sep}).)*+)?+|(?!")(?:(?!{sep}).)*+)'
    return ~F.contains(line, F.lit('"')) | line.rlike(rf"(?s)\A{field}(?:{sep}{field})*+\z")


def _has_multi_line_fields(spark: SparkSession, paths: list[str], spec: Mapping) -> bool:
    """Whether a quoted field goes over a line end.

    Spark's own reader can split only files without such fields. ``multi line`` in the specification
    answers the question without a scan.
    """
    told = spec.get("multi line")
    if told is not None:
        return bool(told)
    return not spark.read.text(paths).where(~_closed(F.col("value"), field_delimiter(spec))).isEmpty()


# Splits


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines in file order within each split, which is known by its file and place."""
    return spark.read.text(paths, lineSep="\n").select(
        F.col("_metadata.file_path").alias(_FILE),
        F.col("_metadata.file_name").alias("source"),
        F.col("_metadata.file_block_start").alias("place"),
        "value",
    )


def _effects(separator: str):
    """What each split of a task makes of both beginnings; lines without quotes change nothing and are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, ends, done = None, [False, True], []
        for batch in batches:
            columns = (batch.column(name).to_pylist() for name in (_FILE, "place", "value"))
            for file, place, value in zip(*columns):
                if (file, place) != current:
                    if current is not None:
                        done.append((*current, *ends))
                    current, ends = (file, place), [False, True]
                ends = [ends_inside(value, ends[0], separator), ends_inside(value, ends[1], separator)]
        if current is not None:
            done.append((*current, *ends))
        names = [_FILE, "place", "from_outside", "from_inside"]
        yield pa.RecordBatch.from_pydict(
            {name: [row[i] for row in done] for i, name in enumerate(names)},
            pa.schema([(_FILE, pa.string()), ("place", pa.int64()), ("from_outside", pa.bool_()), ("from_inside", pa.bool_())]),
        )

    return run


def splits_inside(lines: DataFrame, separator: str) -> DataFrame:
    """Splits that begin inside a quoted field: the composed effect of all splits of a file before them."""
    schema = f"{_FILE} string, place long, from_outside boolean, from_inside boolean"
    quotes = lines.select(_FILE, "place", "value").where(F.contains("value", F.lit('"')))
    effects = quotes.mapInArrow(_effects(separator), schema)
    # Splits without quotes pass on what they get, but may begin inside as well.
    every = lines.select(_FILE, "place").distinct().join(effects, [_FILE, "place"], "left")
    effect = F.struct(
        "place", F.coalesce("from_outside", F.lit(False)).alias("out"), F.coalesce("from_inside", F.lit(True)).alias("in")
    )
    by_file = every.groupBy(_FILE).agg(F.sort_array(F.collect_list(effect)).alias("effects"))

    def step(state: Column, split: Column) -> Column:
        inside = state["inside"]
        return F.struct(
            F.when(inside, split["in"]).otherwise(split["out"]).alias("inside"),
            F.when(inside, F.array_append(state["places"], split["place"])).otherwise(state["places"]).alias("places"),
        )

    start = F.struct(F.lit(False).alias("inside"), F.array().cast("array<bigint>").alias("places"))
    folded = by_file.select(_FILE, F.aggregate("effects", start, step)["places"].alias("places"))
    return folded.select(_FILE, F.explode("places").alias("place"))


def _cut(separator: str, inside: frozenset):
    """Records of the splits of a task; what belongs to a record over a border comes with its place, twice that of its split, and
    one more at the end of a split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, source, held, is_inside, heading, border = None, None, [], False, False, None

        def finished(out: list) -> None:
            """The end of a split: what is open goes on in the next one."""
            if current is not None and held:
                # A split that never leaves the field it begins in is all one piece from the front.
                out.append((current[0], source, border if border is not None else 2 * current[1] + 1, "\n".join(held)))

        for batch in batches:
            out: list[tuple] = []
            columns = (batch.column(name).to_pylist() for name in (_FILE, "source", "place", "value"))
            for file, name, place, value in zip(*columns):
                if (file, place) != current:
                    finished(out)
                    current, source, held = (file, place), name, []
                    is_inside = current in inside
                    heading = place == 0
                    border = 2 * place if is_inside else None
                    if heading:
                        value = value.removeprefix("\ufeff")
                # Most lines have no quote and are a record by themselves.
                if is_inside or '"' in value:
                    is_inside = ends_inside(value.rstrip("\r"), is_inside, separator)
                held.append(value)
                if is_inside:
                    continue
                record = "\n".join(held).rstrip("\r")
                held = []
                if border is not None:
                    out.append((file, name, border, record))
                    border = None
                elif record.strip():
                    if not heading:
                        out.append((file, name, None, record))
                    heading = False
            yield _record_batch(out)
        out = []
        finished(out)
        yield _record_batch(out)

    return run


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    schema = pa.schema([(_FILE, pa.string()), ("source", pa.string()), ("piece", pa.int64()), ("record", pa.string())])
    return pa.RecordBatch.from_pydict({name: [row[i] for row in rows] for i, name in enumerate(schema.names)}, schema)


def records(spark: SparkSession, paths: list[str], separator: str) -> DataFrame:
    """``__file``, ``source`` and ``record`` of all records but the headers, cut in parallel.

    The driver and every task hold one entry for each split that begins inside a quoted field: fewer than the input has splits.
    A lone carriage return does not end a record.
    """
    ship_package(spark)
    lines = _lines(spark, paths)
    inside = frozenset((row[_FILE], row["place"]) for row in splits_inside(lines, separator).collect())
    cut = lines.mapInArrow(_cut(separator, inside), f"{_FILE} string, source string, piece long, record string")
    if not inside:
        return cut.select(_FILE, "source", "record")
    whole = cut.where("piece is null").select(_FILE, "source", "record")
    # A piece from the end of a split begins a record; those from the front of the next ones go on with it.
    order = Window.partitionBy(_FILE).orderBy("piece")
    pieces = cut.where("piece is not null").withColumn("chain", F.sum(F.col("piece") % 2).over(order))
    glued = pieces.groupBy(_FILE, "source", "chain").agg(F.sort_array(F.collect_list(F.struct("piece", "record"))).alias("parts"))
    joined = F.array_join(F.col("parts.record"), "\n")
    return whole.unionByName(glued.select(_FILE, "source", joined.alias("record")))


# Fields


def _by_position(spark: SparkSession, paths: list[str], separator: str, width: int, multi_line: bool) -> DataFrame:
    """Fields of all rows but the headers as texts ``f0``, ``f1``, ...; with the file and its name."""
    fields = StructType([StructField(f"f{i}", StringType()) for i in range(width)])
    if not multi_line:
        rows = spark.read.schema(fields).options(header=True, enforceSchema=True, sep=separator, escape='"').csv(paths)
        return rows.select("*", F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.file_name").alias(SOURCE_FILE_COLUMN))
    options = {"sep": separator, "escape": '"', "multiLine": "true"}
    row = F.from_csv("record", fields.simpleString()[len("struct<") : -1].replace(":", " "), options)
    parsed = records(spark, paths, separator).select(row.alias("row"), _FILE, F.col("source").alias(SOURCE_FILE_COLUMN))
    return parsed.select("row.*", _FILE, SOURCE_FILE_COLUMN)


def _placed(rows: DataFrame, headers: list[list[str]], names: list[str], header: Column) -> list[Column]:
    """Every name from the place that the header (its number) of a row's file has for it; null where it has none."""
    placed = []
    for name in names:
        places = [own.index(name) if name in own else -1 for own in headers]
        if len(set(places)) == 1:
            placed.append((F.col(f"f{places[0]}") if places[0] >= 0 else F.lit(None).cast("string")).alias(name))
            continue
        place = F.get(F.array(*(F.lit(p) for p in places)), header)
        field = F.lit(None).cast("string")
        for known in sorted(set(places) - {-1}):
            field = F.when(place == known, F.col(f"f{known}")).otherwise(field)
        placed.append(field.alias(name))
    return placed


def _inferred(frame: DataFrame, names: list[str]) -> DataFrame:
    """Text columns as whole numbers, numbers or booleans when every value allows it.

    One aggregation over the table decides for all columns: the lowest and highest rank of its
    values. Texts for missing values become null; a column without any value is numeric. Whole numbers beyond 64
    bits stay exact beside fractions too, as decimals where these have the digits, else as texts.
    """
    texts = {n: F.when(~quoted(n).isin(*MISSING_TEXTS), quoted(n)) for n in names}
    frame = frame.withColumns(texts)

    def rank(value: Column) -> Column:
        whole = value.rlike(WHOLE_NUMBER)
        fits, wide = (F.trim(value).try_cast(kind).isNotNull() for kind in ("bigint", f"decimal({WIDEST},0)"))
        flag = F.lower(value).isin("true", "false")
        number = F.when(whole & ~fits & ~wide, 5).when(value.rlike(NUMBER), 3)
        ranked = F.when(whole & fits, 1).when(whole & wide, 2).otherwise(F.coalesce(number, F.when(flag, 4), F.lit(5)))
        return F.when(value.isNotNull(), ranked)

    def facts_of(i: int, rank: Column, value: Column) -> list[Column]:
        number = rank <= 3
        whole = F.regexp_extract(value, r"^\s*[+-]?0*(\d*)", 1)
        fraction = F.regexp_extract(value, r"\.(\d*)", 1)
        return [
            F.min(rank).alias(f"low{i}"),
            F.max(rank).alias(f"high{i}"),
            F.max(rank == 2).alias(f"wide{i}"),
            F.max(F.when(number, F.length(whole))).alias(f"whole{i}"),
            F.max(F.when(rank == 3, F.length(fraction))).alias(f"fraction{i}"),
            F.max(F.when(rank == 3, ~value.rlike(PLAIN_NUMBER))).alias(f"power{i}"),
        ]

    ranked = frame.select(*[c for i, n in enumerate(names) for c in (rank(quoted(n)).alias(f"r{i}"), quoted(n).alias(f"v{i}"))])
    facts = ranked.agg(*[c for i in range(len(names)) for c in facts_of(i, F.col(f"r{i}"), F.col(f"v{i}"))]).first()
    chosen = {}
    for i, name in enumerate(names):
        low, high = facts[f"low{i}"], facts[f"high{i}"]
        kind = {1: "bigint", 2: f"decimal({WIDEST},0)"}.get(high, "double")
        if high == 3 and facts[f"wide{i}"]:
            scale = facts[f"fraction{i}"]
            exact = not facts[f"power{i}"] and facts[f"whole{i}"] + scale <= WIDEST
            kind = f"decimal({WIDEST},{scale})" if exact else "string"
        if high is None or high <= 3:
            chosen[name] = quoted(name) if kind == "string" else F.trim(quoted(name)).cast(kind)
        elif low == high == 4:
            chosen[name] = quoted(name).cast("boolean")
    return frame.withColumns(chosen) if chosen else frame


def load_csv(spark: SparkSession, paths: list[str], spec: Mapping) -> DataFrame:
    """All files in one scan, by column name; without a ``schema`` types are inferred from all values."""
    separator = field_delimiter(spec)
    given = spec.get("schema")
    schema = given if given is None or isinstance(given, StructType) else spark.createDataFrame([], given).schema
    multi_line = _has_multi_line_fields(spark, paths, spec)
    files = _headers(spark, paths, separator)
    texts = [row["header"] for row in files.groupBy("header").agg(F.min("path").alias("first")).orderBy("first").collect()]
    headers = [column_names(text, separator) for text in texts]
    names = [f.name for f in schema] if schema is not None else list(dict.fromkeys(name for own in headers for name in own))
    rows = _by_position(spark, paths, separator, max(map(len, headers), default=1), multi_line)
    header = F.lit(0)
    if len({tuple(own) for own in headers}) > 1:
        # One row per file; Spark broadcasts it as far as its own limit goes.
        known = scratch_path(spark, "headers")
        files.select(F.col("path").alias(_FILE), F.array_position(F.array(*map(F.lit, texts)), F.col("header")).cast("int").alias("__header")).write.parquet(known)
        rows = rows.join(spark.read.schema(f"{_FILE} string, __header int").parquet(known), _FILE)
        header = F.col("__header") - 1
    table = rows.select(*_placed(rows, headers, names, header), SOURCE_FILE_COLUMN)
    if schema is None:
        return _inferred(table, names)
    return table.select(*(quoted(f.name).try_cast(f.dataType).alias(f.name) for f in schema), SOURCE_FILE_COLUMN)
