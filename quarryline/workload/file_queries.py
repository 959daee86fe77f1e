"""Sources and sinks: whole tables written to the shared scratch folder and read back."""

from __future__ import annotations

from datetime import datetime
from itertools import permutations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.functions.dates import moment_literal
from quarryline.functions.text import base_name
from quarryline.operators import aggregates, filters
from quarryline.runtime import estimated_bytes, scratch_path
from quarryline.sources import files, sinks
from quarryline.sources.formats import SOURCE_FILE_COLUMN
from quarryline.workload.registry import query, register, table

# --------------------------------------------------------------------------- round trips

_ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders"

_CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"
    )


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")


def _there_and_back(df: DataFrame, label: str, **spec) -> DataFrame:
    """Save with a specification, load with the same one, drop the provenance column."""
    spark = df.sparkSession
    spec["name"] = scratch_path(spark, label) + spec.pop("ending", "")
    sinks.save(df, spec)
    back = files.load(spark, {**spec, "file list": [spec["name"]]}).drop(SOURCE_FILE_COLUMN)
    kinds = dict(df.dtypes)
    return back.select(*[F.col(c).cast(kinds[c]).alias(c) for c in df.columns])


def _register_round_trip(name: str, source, sql: str, **spec) -> None:
    def run(spark, sf_dir):
        return _there_and_back(source(spark, sf_dir), name, **spec)

    register(name, run, sql)


_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz"

_CUSTOMER_SCHEMA = "c_custkey bigint, c_name string, c_nationkey bigint, c_acctbal double"

_register_round_trip("K1_csv_sink", _orders, _ORDERS_SQL, format="csv", **{"field delimiter": "|"}, schema=_SCHEMA)
_register_round_trip("K1_csv_sink_gzip", _orders, _ORDERS_SQL, format="csv", compression="gzip", schema=_SCHEMA)
_register_round_trip("K2_excel_sink", _customers, _CUSTOMER_SQL, format="excel", schema=_CUSTOMER_SCHEMA, ending=".xlsx")
_register_round_trip("K3_json_sink", _orders, _ORDERS_SQL, format="json", schema=_SCHEMA)
_register_round_trip("K4_parquet_sink_snappy", _orders, _ORDERS_SQL, format="parquet", compression="snappy")
_register_round_trip("K4_parquet_sink_gzip", _orders, _ORDERS_SQL, format="parquet", compression="gzip")
_register_round_trip("K4_parquet_sink_uncompressed", _orders, _ORDERS_SQL, format="parquet", compression="none")
_register_round_trip("K5_pickle_sink", _orders, _ORDERS_SQL, format="pickle", compression="gzip")
_register_round_trip("K5_pickle_sink_bz2", _customers, _CUSTOMER_SQL, format="pickle", compression="bz2")
_register_round_trip("K5_pickle_sink_zip", _customers, _CUSTOMER_SQL, format="pickle", compression="zip")
_register_round_trip("K5_pickle_sink_infer_xz", _customers, _CUSTOMER_SQL, format="pickle", ending=".xz")
_register_round_trip("K6_save_dispatch", _orders, _ORDERS_SQL, format="JSON", compression="none", schema=_SCHEMA)
_register_round_trip("S5_csv_source_inferred", _orders, _ORDERS_SQL, format="csv", **{"field-delimiter": ";"})
_register_round_trip("S6_excel_source_inferred", _customers, _CUSTOMER_SQL, format="excel", **{"worksheet list": [0]})
_register_round_trip("S7_json_source_inferred", _orders, _ORDERS_SQL, format="json", compression="gzip")
_register_round_trip("S8_parquet_source", _orders, _ORDERS_SQL, format="parquet", schema=_SCHEMA)
_register_round_trip("S9_pickle_source", _orders, _ORDERS_SQL, format="pickle", compression="none")
_register_round_trip("S10_load_dispatch", _orders, _ORDERS_SQL, format="Parquet")
_register_round_trip("S11_load_defaults", _customers, _CUSTOMER_SQL, format="csv")

# --------------------------------------------------------------------------- unions of files

_DRIFT_SQL = """SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END
    AS o_orderpriority FROM orders"""


def _drifting_slices(spark: SparkSession, sf_dir: str, spec: dict) -> list[str]:
    """Two outputs that hold all orders between them; the second one has a column more."""
    orders = table(spark, sf_dir, "orders")
    done = orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")
    rest = orders.where("o_orderstatus <> 'F'").select("o_orderkey", "o_totalprice", "o_orderpriority")
    names = [scratch_path(spark, "slice-done"), scratch_path(spark, "slice-rest")]
    for slice_, name in zip((done, rest), names):
        sinks.save(slice_, {**spec, "name": name})
    return names


def _register_drift(name: str, chosen: str) -> None:
    def run(spark, sf_dir):
        spec = {"format": chosen}
        loaded = files.load(spark, {**spec, "file list": _drifting_slices(spark, sf_dir, spec)})
        return loaded.select("o_orderkey", "o_totalprice", "o_orderpriority")

    register(name, run, _DRIFT_SQL)


for _format in ("csv", "json", "parquet", "pickle", "excel"):
    _register_drift(f"U1_union_{_format}_files", _format)


@query(
    "U1_union_json_layouts",
    "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders",
)
def union_json_layouts(spark, sf_dir):
    """Orders written as lines, as lists of records and as columns of rows, by status, and read as one table."""
    orders = table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderkey", "o_totalprice", "o_orderpriority")
    names = orders.columns[1:]
    # Keys of one document, which is one value.
    part = F.floor(F.col("o_orderkey") / 20_000).alias("part")
    lines, records, columns = (scratch_path(spark, f"layout-{kind}") for kind in ("lines", "records", "columns"))
    sinks.save(orders.where("o_orderstatus = 'F'").select(*names), {"format": "json", "name": lines})
    listed = F.to_json(F.collect_list(F.struct(*names))).alias("value")
    orders.where("o_orderstatus = 'O'").groupBy(part).agg(listed).write.partitionBy("part").text(records)
    row = F.col("o_orderkey").cast("string")
    cells = [F.map_from_entries(F.collect_list(F.struct(row, name))).alias(name) for name in names]
    rest = orders.where("o_orderstatus not in ('F', 'O') or o_orderstatus is null")
    rest.groupBy(part).agg(F.to_json(F.struct(*cells)).alias("value")).write.partitionBy("part").text(columns)
    loaded = files.load(spark, {"format": "json", "file list": [lines, f"{records}/part=*", f"{columns}/part=*"]})
    return loaded.select(*names)


@query(
    "S5_csv_wide_with_fraction",
    """SELECT o_orderkey, CAST(12345678901234560000 + o_orderkey AS DECIMAL(38,2))
        + CASE WHEN o_orderkey % 3 = 0 THEN 0.25 ELSE 0 END AS wide FROM orders""",
)
def csv_wide_with_fraction(spark, sf_dir):
    """Identifiers of twenty digits beside fractions stay apart."""
    wide = F.lit("12345678901234560000").cast("decimal(30,0)") + F.col("o_orderkey")
    text = F.concat(wide.cast("decimal(30,0)").cast("string"), F.when(F.col("o_orderkey") % 3 == 0, ".25").otherwise(""))
    written = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("wide"))
    spec = {"format": "csv", "name": scratch_path(spark, "wide")}
    sinks.save(written, spec)
    return files.load(spark, {**spec, "file list": [spec["name"]]}).select("o_orderkey", F.col("wide").cast("decimal(38,2)").alias("wide"))


@query(
    "S5_csv_fields_over_lines",
    """SELECT o_orderkey, o_orderstatus || chr(10) || 'said "' || o_orderpriority || '",' || chr(10) || repeat('x' || chr(10), o_orderkey % 9) AS note
        FROM orders""",
)
def csv_fields_over_lines(spark, sf_dir):
    """Quoted fields with line ends, delimiters and quotes; splits are cut into records in parallel."""
    note = F.concat(
        "o_orderstatus", F.lit('\nsaid "'), "o_orderpriority", F.lit('",\n'), F.repeat(F.lit("x\n"), (F.col("o_orderkey") % 9).cast("int"))
    )
    spec = {"format": "csv", "name": scratch_path(spark, "notes")}
    sinks.save(table(spark, sf_dir, "orders").select("o_orderkey", note.alias("note")), spec)
    return files.load(spark, {**spec, "file list": [spec["name"]], "schema": "o_orderkey bigint, note string"}).select("o_orderkey", "note")


@query("U1_union_csv_headers", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders")
def union_csv_headers(spark, sf_dir):
    """Twelve outputs whose headers differ in order, read in one scan."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    base = scratch_path(spark, "headers")
    for i, names in enumerate(list(permutations(orders.columns))[:12]):
        sinks.save(orders.where(F.col("o_orderkey") % 12 == i).select(*names), {"format": "csv", "name": f"{base}/{i}"})
    return files.load(spark, {"format": "csv", "file list": [f"{base}/*"]}).select(*orders.columns)


# Bytes of the table that are worth a file of lines, and a task to write it.
_LINES_BYTES = 8 * 1024 * 1024


@query("S7_json_one_line_record", "SELECT o_orderkey, o_custkey FROM orders")
def json_one_line_record(spark, sf_dir):
    """Files of one line each, which alone could be columns of rows, take the layout of the lines beside them."""
    key = F.col("o_orderkey")
    folder = scratch_path(spark, "one-line")
    record = F.to_json(F.struct(F.struct(key.alias("7"), F.col("o_custkey").alias("8")).alias("o")))
    orders = table(spark, sf_dir, "orders")
    records = orders.select(key, record.alias("value"))
    single = (key < 4) & (key != 0)
    alone = records.where(single).select("value", key.cast("string").alias("part"))
    alone.repartition("part").write.partitionBy("part").text(folder)
    # The lines are written where they are read: shuffled to their part, all but a few would be sorted by one task. Only tables
    # too small for several files are brought together, so that these do not end as single lines too.
    lines = records.where(~F.coalesce(single, F.lit(False))).select("value")
    lines.coalesce(max(1, (estimated_bytes(orders) or 0) // _LINES_BYTES)).write.text(f"{folder}/part=0")
    loaded = files.load(spark, {"format": "json", "file list": [folder]})
    return loaded.select(F.col("o.7").alias("o_orderkey"), F.col("o.8").alias("o_custkey"))


@query(
    "P10_source_file_name",
    """SELECT 'part-' AS prefix, o_orderpriority IS NULL AS first_slice,
        count(*) AS n FROM (SELECT CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority FROM orders)
        GROUP BY ALL""",
)
def source_file_name(spark, sf_dir):
    spec = {"format": "parquet"}
    loaded = files.load(spark, {**spec, "file list": _drifting_slices(spark, sf_dir, spec)})
    prefix = F.substring(SOURCE_FILE_COLUMN, 1, 5).alias("prefix")
    first = F.col("o_orderpriority").isNull().alias("first_slice")
    return loaded.groupBy(prefix, first).agg(F.count(F.lit(1)).alias("n"))


@query("A6_file_count", "SELECT CAST(3 AS BIGINT) AS files_counted")
def file_count(spark, sf_dir):
    return aggregates.file_count(
        spark.read.option("mergeSchema", True).parquet(
            *[f"{sf_dir}/{name}.parquet" for name in ("orders", "lineitem", "events")]
        )
    )


@query("J2_ingest", "SELECT o_orderkey, o_totalprice FROM orders")
def ingest(spark, sf_dir):
    folder = scratch_path(spark, "ingest")
    orders = table(spark, sf_dir, "orders")
    for label, status in (("done", "= 'F'"), ("rest", "<> 'F'")):
        part = orders.where(f"o_orderstatus {status}").select("o_orderkey", "o_totalprice")
        sinks.save(part, {"format": "csv", "name": f"{folder}/{label}.csv"})
    return files.ingest(spark, f"{folder}/*.csv", {"format": "csv"}).select("o_orderkey", "o_totalprice")


# --------------------------------------------------------------------------- fan-out


@query(
    "K7_fan_out",
    " UNION ALL ".join(f"SELECT '{f}' AS target, o_orderkey, o_totalprice FROM orders" for f in ("csv", "json", "parquet")),
)
def fan_out(spark, sf_dir):
    base = scratch_path(spark, "fan-out")
    targets = [{"format": f, "name": f"{base}.{f}"} for f in ("csv", "json", "parquet")]
    sinks.save_all(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), targets)
    loaded = [
        files.load(spark, {**t, "file list": [t["name"]]}).select(
            F.lit(t["format"]).alias("target"), "o_orderkey", "o_totalprice"
        )
        for t in targets
    ]
    return loaded[0].unionByName(loaded[1]).unionByName(loaded[2])


@query(
    "K8_empty_result_suppression",
    "SELECT 'none' AS result, 0 AS written, false AS found UNION ALL SELECT 'all', 1, true",
)
def empty_result(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    rows = []
    for label, condition in (("none", "o_totalprice < 0"), ("all", "o_totalprice >= 0")):
        name = scratch_path(spark, f"suppress-{label}")
        written = sinks.save_all(orders.where(condition), {"format": "parquet", "name": name})
        rows.append((label, len(written), bool(files.build_file_list(spark, name))))
    return spark.createDataFrame(rows, "result string, written int, found boolean")


# --------------------------------------------------------------------------- file tables


_TABLES = (
    "benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels", "lineitem", "nation",
    "orders", "pages", "part", "region", "supplier",
)

_FILES_SQL = f"""(SELECT name || '.parquet' AS file FROM (VALUES {", ".join(f"('{t}')" for t in _TABLES)}) AS t(name))"""


@query("S12_file_listing", f"SELECT file, true AS has_length, true AS has_time FROM {_FILES_SQL}")
def file_listing(spark, sf_dir):
    return files.list_files(spark, sf_dir, "*.parquet").select(
        base_name("path").alias("file"),
        (F.col("length") > 0).alias("has_length"),
        F.col("modificationTime").isNotNull().alias("has_time"),
    )


@query("S13_whole_text", "SELECT doc_id, md5(text) AS digest FROM documents")
def whole_text(spark, sf_dir):
    """Every document as a whole text again, read from files with one document per file row."""
    path = scratch_path(spark, "texts")
    packed = F.concat(F.col("doc_id").cast("string"), F.lit("\x1d"), "text", F.lit("\x1e"))
    lines = table(spark, sf_dir, "documents").select(packed.alias("value"))
    lines.write.options(lineSep="\x1f", maxRecordsPerFile=1_000).text(path)
    whole = files.read_text_document(spark, path)
    texts = whole.select(F.explode(F.split("value", "\x1e\x1f")).alias("t")).where("t <> ''")
    parts = F.split("t", "\x1d", 2)
    return texts.select(parts[0].cast("bigint").alias("doc_id"), F.md5(parts[1]).alias("digest"))


# Documents dealt to 64 files by a digest of their key; a file holds one line per document, or one line about all of them.
_DEALT_SQL = """SELECT substr(md5(CAST(doc_id AS VARCHAR)), 1, 1) || CAST(doc_id % 4 AS VARCHAR) AS dealt,
    CAST(doc_id AS VARCHAR) || ':' || CAST(n_chars AS VARCHAR) AS line, n_chars FROM documents"""


def _dealt_files(spark, sf_dir, about: bool) -> str:
    """A folder with one file per part, in subfolders named by the part."""
    folder = scratch_path(spark, "dealt")
    key = F.col("doc_id").cast("string")
    dealt = F.concat(F.substring(F.md5(key), 1, 1), (F.col("doc_id") % 4).cast("string")).alias("dealt")
    lines = table(spark, sf_dir, "documents").select(dealt, F.concat(key, F.lit(":"), "n_chars").alias("value"), "n_chars")
    if about:
        counts = F.concat("dealt", F.lit(" "), F.count("*"), F.lit(" "), F.sum("n_chars"))
        lines = lines.groupBy("dealt").agg(counts.alias("value"))
    lines.select("dealt", "value").repartition("dealt").write.partitionBy("dealt").text(folder)
    return folder


def _dealt():
    return F.regexp_extract("path", "dealt=([^/]+)/", 1).alias("dealt")


@query("X1_file_size_planted", f"SELECT dealt, CAST(sum(strlen(line) + 1) AS BIGINT) AS size FROM ({_DEALT_SQL}) GROUP BY dealt")
def file_size_planted(spark, sf_dir):
    found = files.file_statistics(spark, _dealt_files(spark, sf_dir, False), pattern="part-*")
    return found.select(_dealt(), F.col("size [bytes]").alias("size"))


@query(
    "X2_file_dates_planted",
    f"SELECT dealt, true AS after_start, true AS before_end, count(*) AS documents FROM ({_DEALT_SQL}) GROUP BY dealt",
)
def file_dates_planted(spark, sf_dir):
    """Files written now have changed between two looks at the clock; their lines are counted beside them."""
    clock = F.current_timestamp().alias("t")
    start = spark.range(1).select(clock).first()["t"]
    folder = _dealt_files(spark, sf_dir, False)
    end = spark.range(1).select(clock).first()["t"]
    changed = F.col("date when last modified")
    found = files.file_statistics(spark, folder, pattern="part-*").select(
        _dealt(),
        # File systems may keep whole seconds only.
        (changed >= F.date_trunc("second", F.lit(start))).alias("after_start"),
        (changed <= F.lit(end)).alias("before_end"),
    )
    lines = spark.read.text(folder).groupBy("dealt").agg(F.count("*").alias("documents"))
    return found.join(lines, "dealt")


@query(
    "X3_file_statistics_planted",
    f"""SELECT dealt, CAST(strlen(content) AS BIGINT) AS size, md5(content) AS "MD5 Checksum", sha1(content) AS "SHA1 Checksum",
        sha256(content) AS "SHA256 Checksum" FROM (SELECT dealt, dealt || ' ' || CAST(count(*) AS VARCHAR) || ' '
        || CAST(sum(n_chars) AS VARCHAR) || chr(10) AS content FROM ({_DEALT_SQL}) GROUP BY dealt)""",
)
def file_statistics_planted(spark, sf_dir):
    """Sizes and digests of files whose content is known from the table, half of them hashed as streams."""
    found = files.file_statistics(spark, _dealt_files(spark, sf_dir, True), checksum=True, pattern="part-*", whole_file_limit=10)
    return found.select(_dealt(), F.col("size [bytes]").alias("size"), "MD5 Checksum", "SHA1 Checksum", "SHA256 Checksum")


@query("X1_file_size")
def file_size(spark, sf_dir):
    return files.file_statistics(spark, sf_dir).select("file name", "size [bytes]")


@query("X2_file_dates")
def file_dates(spark, sf_dir):
    return files.file_statistics(spark, sf_dir).select("file name", "date when last modified")


@query("X3_file_statistics")
def file_facts(spark, sf_dir):
    return files.file_statistics(spark, sf_dir)


@query("X3_file_statistics_with_checksums")
def file_checksums(spark, sf_dir):
    return files.file_statistics(spark, sf_dir, checksum=True)


@query("X3_streamed_checksums", "SELECT count(*) AS files, true AS same FROM (SELECT unnest(range(14)))")
def streamed_checksums(spark, sf_dir):
    """Both ways of hashing give the same digests for every file."""
    whole = files.file_statistics(spark, sf_dir, checksum=True).drop("path")
    streamed = files.file_statistics(spark, sf_dir, checksum=True, whole_file_limit=0).drop("path")
    both = whole.join(streamed, whole.columns, "left_anti")
    return whole.agg(F.count(F.lit(1)).alias("files")).withColumn("same", F.lit(both.isEmpty()))


@query("X4_file_date_verdict", "SELECT 'newer' AS verdict, count(*) AS n FROM (SELECT unnest(range(14)))")
def file_date_verdict(spark, sf_dir):
    listed = files.list_files(spark, sf_dir, "*.parquet")
    listed = listed.withColumn("modificationTime", F.col("modificationTime").cast("timestamp_ntz"))
    judged = filters.add_age_verdict(listed, "modificationTime", moment_literal(datetime(1960, 1, 1)))
    return judged.groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))


@query("J3_stale_file_report", f"SELECT file, '2998-12-30 00:00:00' AS barrier, 'older' AS verdict FROM {_FILES_SQL}")
def stale_files(spark, sf_dir):
    report = files.stale_file_report(spark, sf_dir, "CalculatedDate_CYCMCDCH_-48", datetime(2999, 1, 1), "*.parquet")
    return report.select(base_name("path").alias("file"), F.col("barrier").cast("string").alias("barrier"), "verdict")


@query(
    "K14_output_statistics",
    """SELECT 'csv' AS output, true AS has_bytes, true AS has_digest, true AS has_date UNION ALL
        SELECT 'parquet', true, true, true""",
)
def output_statistics(spark, sf_dir):
    base = scratch_path(spark, "audited")
    targets = [{"format": f, "name": f"{base}.{f}"} for f in ("csv", "parquet")]
    sinks.save_all(_orders(spark, sf_dir), targets)
    audited = sinks.output_statistics(spark, [t["name"] for t in targets], checksum=True)
    output = F.element_at(F.split("output", "\\."), -1).alias("output")
    return audited.groupBy(output).agg(
        (F.sum("size [bytes]") > 0).alias("has_bytes"),
        F.bool_and(F.length("SHA512 Checksum") == 128).alias("has_digest"),
        F.bool_and(F.col("date when last modified").isNotNull()).alias("has_date"),
    )
