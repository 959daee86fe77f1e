"""Interval, date, text, checksum and column operators."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.functions import arrays, checksums, dates, text
from quarryline.operators import columns
from quarryline.operators.aggregates import every_true, min_max_by_group
from quarryline.plans.reports import interval_timeline
from quarryline.plans.template import DEFAULT_RULES, template_scan
from quarryline.workload.registry import query, register, table

REFERENCE = "1998-03-01"

AS_OF = datetime(2024, 5, 31, 10, 20, 30, 123456)


def _intervals(spark, sf_dir):
    names = {"l_shipdate_min": "Start Date", "l_shipdate_max": "End Date"}
    return min_max_by_group(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_shipdate", names)


INTERVALS_SQL = """(SELECT l_orderkey, min(l_shipdate) AS "Start Date", max(l_shipdate) AS "End Date"
    FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey)"""

DAYS_SQL = """CAST(date_diff('day', "Start Date", "End Date") + 1 AS INTEGER) AS "Days Within" """

TIMELINE_SQL = f"""CASE WHEN "Start Date" <= TIMESTAMP '{REFERENCE}' AND TIMESTAMP '{REFERENCE}' <= "End Date"
    THEN 'Current' WHEN "Start Date" < TIMESTAMP '{REFERENCE}' THEN 'Past' ELSE 'Future' END"""


@query("D23_days_within", f"SELECT l_orderkey, {DAYS_SQL} FROM {INTERVALS_SQL}")
def days_within(spark, sf_dir):
    return dates.add_days_within(_intervals(spark, sf_dir)).select("l_orderkey", "Days Within")


@query(
    "D24_timeline_evaluation",
    f"""SELECT l_orderkey, {TIMELINE_SQL} AS "Timeline Evaluation" FROM {INTERVALS_SQL}""",
)
def timeline_evaluation(spark, sf_dir):
    placed = dates.add_timeline_evaluation(_intervals(spark, sf_dir), REFERENCE)
    return placed.select("l_orderkey", "Timeline Evaluation")


@query(
    "D25_weekday_columns",
    """SELECT o_orderkey, dayname(o_orderdate) AS "Weekday for o_orderdate" FROM orders""",
)
def weekday_columns(spark, sf_dir):
    named = dates.add_weekday_columns(table(spark, sf_dir, "orders"), ["o_orderdate"])
    return named.select("o_orderkey", "Weekday for o_orderdate")


@query(
    "D26_datetime_to_string",
    "SELECT event_id, strftime(ts, '%d/%m/%Y %H:%M:%S.%f day %j, %A %B') AS ts FROM events",
)
def datetime_to_string(spark, sf_dir):
    printed = dates.datetime_to_string(table(spark, sf_dir, "events"), ["ts"], "%d/%m/%Y %H:%M:%S.%f day %j, %A %B")
    return printed.select("event_id", "ts")


@query("D27_string_to_datetime", "SELECT event_id, ts FROM events")
def string_to_datetime(spark, sf_dir):
    printed = dates.datetime_to_string(table(spark, sf_dir, "events"), ["ts"], "%d.%m.%Y %H:%M:%S.%f")
    return dates.string_to_datetime(printed, ["ts"], "%d.%m.%Y %H:%M:%S.%f").select("event_id", "ts")


@query(
    "D26_datetime_directives",
    """SELECT event_id, strftime(ts, '%w %U %W') || ' ' || strftime(ts, '%m/%d/%y %Y-%m-%d %H:%M:%S') || ' '
        || strftime(ts, '%a %b ') || lpad(strftime(ts, '%-d'), 2, ' ') || strftime(ts, ' %H:%M:%S %Y') AS ts FROM events""",
)
def datetime_directives(spark, sf_dir):
    """Week numbers, and directives that stand for others."""
    printed = dates.datetime_to_string(table(spark, sf_dir, "events"), ["ts"], "%w %U %W %D %F %T %c")
    return printed.select("event_id", "ts")


@query(
    "D27_string_to_datetime_short_fields",
    """SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS by_numbers, CAST(o_orderdate AS TIMESTAMP) AS by_names,
        date_trunc('week', o_orderdate)::TIMESTAMP AS by_week FROM orders""",
)
def string_to_datetime_short_fields(spark, sf_dir):
    """Days and months of one digit, names of weekdays and months, and weeks counted from Monday."""
    day = F.col("o_orderdate")
    written = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat_ws("/", F.dayofmonth(day), F.month(day), F.year(day)).alias("by_numbers"),
        F.upper(F.date_format(day, "EEEE d MMM yyyy")).alias("by_names"),
        F.concat(F.extract(F.lit("YEAROFWEEK"), day), F.lit("-"), F.weekofyear(day), F.lit("-Mon")).alias("by_week"),
    )
    read = dates.string_to_datetime(written, ["by_numbers"], "%d/%m/%Y")
    read = dates.string_to_datetime(read, ["by_names"], "%A %d %b %Y")
    return dates.string_to_datetime(read, ["by_week"], "%G-%V-%a")


@query(
    "D28_now_and_utcnow",
    """SELECT o_orderkey, o_orderdate < CAST(now() AS TIMESTAMP) AS before_now,
        o_orderdate < CAST(now() AS TIMESTAMP) AS before_utcnow FROM orders""",
)
def now_and_utcnow(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        (F.col("o_orderdate") < dates.now_local()).alias("before_now"),
        (F.col("o_orderdate") < dates.now_utc()).alias("before_utcnow"),
    )


@query(
    "D29_epoch_seconds",
    """SELECT o_orderkey, strftime(make_timestamp(o_custkey * 1000000), '%Y-%m-%d %H:%M:%S.%f') AS at
        FROM orders""",
)
def epoch_seconds(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.epoch_to_string("o_custkey").alias("at")
    )


@query(
    "J4_interval_timeline",
    f"""SELECT l_orderkey, "Start Date", "End Date", {DAYS_SQL}, {TIMELINE_SQL} AS "Timeline Evaluation",
        dayname("Start Date") AS "Weekday for Start Date", dayname("End Date") AS "Weekday for End Date"
        FROM {INTERVALS_SQL}""",
)
def timeline_report(spark, sf_dir):
    return interval_timeline(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_shipdate", REFERENCE)


@query(
    "T1_single_line",
    r"""SELECT doc_id, regexp_replace(regexp_replace(replace(regexp_replace(
        translate(text, chr(13) || chr(10), '  '), '[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}]{2,100}', ' ', 'g'),
        ' , ', ', '), '^[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}]+', ''), '[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}]+$', '')
        AS line FROM documents""",
)
def single_line(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.single_line("text").alias("line"))


@query(
    "T2_leading_zeros",
    """SELECT o_orderkey, CASE WHEN length(k) < 4 THEN lpad(k, 4, '0') ELSE k END AS padded
        FROM (SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS k FROM orders)""",
)
def leading_zeros(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", text.pad_zeros(F.col("o_orderkey").cast("string"), 4).alias("padded")
    )


@query(
    "T3_url_check",
    r"""SELECT page_id, regexp_matches(url, '^https?://(?:www)?(?:[\p{L}\p{N}_-]{2,255}(?:\.[\p{L}\p{N}_]{2,66}){1,2})')
        AS is_url FROM pages""",
)
def url_check(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.is_url("url").alias("is_url"))


@query(
    "T4_render_list",
    "SELECT p_partkey, 'IN (''' || replace(p_name, ' ', ''', ''') || ''')' AS rendered FROM part",
)
def render_list(spark, sf_dir):
    words = F.split("p_name", " ")
    return table(spark, sf_dir, "part").select(
        "p_partkey", text.render_list(words, "', '", "IN ('", "')").alias("rendered")
    )


@query(
    "T5_render_dict",
    "SELECT s_suppkey, 'IN (' || s_name || ', ' || CAST(s_nationkey AS VARCHAR) || ')' AS rendered FROM supplier",
)
def render_dict(spark, sf_dir):
    items = F.create_map(F.lit("name"), "s_name", F.lit("nation"), F.col("s_nationkey").cast("string"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", text.render_dict(items).alias("rendered"))


@query(
    "T8_placeholder_count",
    "SELECT p_partkey, CAST(length(p_name) - length(replace(p_name, ' ', '')) AS INTEGER) AS placeholders FROM part",
)
def placeholder_count(spark, sf_dir):
    template = F.replace(F.col("p_name"), F.lit(" "), F.lit(" = %s "))
    return table(spark, sf_dir, "part").select("p_partkey", text.count_placeholders(template).alias("placeholders"))


@query(
    "T9_fill_empty",
    r"""SELECT l_orderkey, l_linenumber, regexp_replace(coalesce(CAST(nullif(l_quantity, 1) AS VARCHAR), '-'),
        '^(-?\d+)\.0$', '\1') AS quantity, coalesce(nullif(l_returnflag, 'N'), '-') AS flag FROM lineitem""",
)
def fill_empty(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        text.fill_empty(F.nullif("l_quantity", F.lit(1.0)), "-").alias("quantity"),
        text.fill_empty(F.nullif("l_returnflag", F.lit("N")), "-").alias("flag"),
    )


@query("T10_base_name", "SELECT page_id, string_split(url, '/')[-1] AS name FROM pages")
def base_name(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.base_name("url").alias("name"))


@query(
    "T11_enum_with_default",
    """SELECT event_id, CASE WHEN event_type IN ('click', 'signup') THEN event_type ELSE 'other' END AS kind
        FROM events""",
)
def enum_with_default(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", text.enum_or_default("event_type", ("click", "signup"), "other").alias("kind")
    )


def _register_checksum(name: str, column, sql_function: str | None) -> None:
    def run(spark, sf_dir):
        return table(spark, sf_dir, "documents").select("doc_id", column(F.col("text")).alias("digest"))

    sql = f"SELECT doc_id, {sql_function}(text) AS digest FROM documents" if sql_function else None
    register(name, run, sql)


_register_checksum("H1_md5", checksums.md5, "md5")
_register_checksum("H2_sha1", checksums.sha1, "sha1")
_register_checksum("H3_sha224", lambda c: checksums.sha2(c, 224), None)
_register_checksum("H4_sha256", lambda c: checksums.sha2(c, 256), "sha256")
_register_checksum("H5_sha384", lambda c: checksums.sha2(c, 384), None)
_register_checksum("H6_sha512", lambda c: checksums.sha2(c, 512), None)


def _register_digest_groups(name, bits):
    """Digests that SQL does not know: equal exactly where texts are, and of the right length."""

    @query(
        name,
        f"""SELECT doc_id, {bits // 4} AS digits, count(*) OVER (PARTITION BY text) AS copies, true AS hexadecimal
            FROM documents""",
    )
    def digest_groups(spark, sf_dir):
        digests = table(spark, sf_dir, "documents").select("doc_id", checksums.sha2("text", bits).alias("digest"))
        sizes = digests.groupBy("digest").agg(F.count("*").alias("copies"))
        return digests.join(sizes, "digest").select(
            "doc_id", F.length("digest").alias("digits"), "copies", F.col("digest").rlike("^[0-9a-f]+$").alias("hexadecimal")
        )


_register_digest_groups("H3_sha224_groups", 224)
_register_digest_groups("H5_sha384_groups", 384)
_register_digest_groups("H6_sha512_groups", 512)


@query(
    "P2_property_inheritance",
    """SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 0 THEN r_name WHEN n_nationkey % 3 = 1 THEN 'WORLD'
        ELSE n_name END AS owner FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
def property_inheritance(spark, sf_dir):
    kind = F.col("n_nationkey") % 3
    own = F.when(kind == 0, columns.FROM_PARENT).when(kind == 1, columns.FROM_GRAND_PARENT).otherwise(F.col("n_name"))
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", columns.inherit(own, F.col("r_name"), F.lit("WORLD")).alias("owner")
    )


@query(
    "P3_default_rules",
    """SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN s_name ELSE 'IN (' || s_name || ')' END AS rendered
        FROM supplier""",
)
def default_rules(spark, sf_dir):
    own_prefix, own_suffix = (F.when(F.col("s_acctbal") < 0, "") for _ in range(2))
    prefix, suffix = F.coalesce(own_prefix, F.lit("IN (")), F.coalesce(own_suffix, F.lit(")"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(prefix, "s_name", suffix).alias("rendered"))


@query(
    "P3_default_rules_in_templates",
    """SELECT 'mapping' AS kind, o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'O')
        UNION ALL SELECT 'list', o_orderkey FROM orders WHERE o_custkey IN (1, 2, 3, 5, 8)
        UNION ALL SELECT 'own rules', o_orderkey FROM orders WHERE o_custkey = 1 OR o_custkey = 4""",
)
def default_rules_in_templates(spark, sf_dir):
    """Mappings and lists among the parameters of a template, joined by the rules of none and of a plan."""
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders_of_rules")
    start = "SELECT o_orderkey FROM orders_of_rules WHERE "
    own = {**DEFAULT_RULES, "list-values-glue": " OR o_custkey = ", "list-values-prefix": "(o_custkey = ", "list-values-suffix": ")"}
    cases = [
        ("mapping", "o_orderstatus %s", [{"done": "'F'", "open": "'O'"}], None),
        ("list", "o_custkey IN (%s)", [[1, 2, 3, 5, 8]], None),
        ("own rules", "%s", [[1, 4]], own),
    ]
    parts = [
        template_scan(spark, start + condition, parameters, AS_OF, rules).select(F.lit(kind).alias("kind"), "o_orderkey")
        for kind, condition, parameters, rules in cases
    ]
    return reduce(DataFrame.unionByName, parts)


@query("P4_select_fields", "SELECT l_orderkey, l_quantity, l_shipdate FROM lineitem")
def select_fields(spark, sf_dir):
    return columns.select_fields(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_quantity", "l_shipdate"])


@query(
    "P5_additional_columns",
    """SELECT s_suppkey, 'Production' AS "Extracted Layer", 7 AS "Batch",
        '2024-05-31 10:20:30.123456' AS "Calculated Timestamp [UTC]",
        '2024-05-31 10:20:30.123456' AS "Calculated Timestamp" FROM supplier""",
)
def additional_columns(spark, sf_dir):
    wanted = [
        {"name": "Extracted Layer", "value": "Production"},
        {"name": "Batch", "value": 7},
        {"name": "Calculated Timestamp [UTC]", "value": "utcnow"},
        {"name": "Calculated Timestamp", "value": "now"},
    ]
    added = columns.add_columns(table(spark, sf_dir, "supplier").select("s_suppkey"), wanted, AS_OF)
    stamps = ["Calculated Timestamp [UTC]", "Calculated Timestamp"]
    return dates.datetime_to_string(added, stamps, "%Y-%m-%d %H:%M:%S.%f")


@query("P6_rename_columns", 'SELECT s_suppkey AS "Key", s_name AS "Full Name" FROM supplier')
def rename_columns(spark, sf_dir):
    names = {"s_suppkey": "Key", "s_name": "Full Name", "not there": "ignored"}
    return columns.rename_columns(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), names)


@query("P7_drop_helper", f"SELECT l_orderkey, TIMESTAMP '{REFERENCE}' AS \"Reference Date\" FROM {INTERVALS_SQL}")
def drop_helper(spark, sf_dir):
    kept = dates.add_timeline_evaluation(_intervals(spark, sf_dir), REFERENCE, remove_reference_date=False)
    for helper in ("Timeline Evaluation", "Start Date", "End Date"):
        kept = columns.drop_helper(kept, helper)
    return columns.drop_helper(kept, "Reference Date", removal=False)


@query(
    "P8_insert_at_position",
    """SELECT p_partkey, array_to_string(list_prepend('0', w), '|') AS at_first,
        array_to_string(list_append(w, '0'), '|') AS at_last,
        array_to_string(w[1:list_position(w, 'widget') - 1] || ['0'] || w[list_position(w, 'widget'):], '|') AS before,
        array_to_string(w[1:list_position(w, 'widget')] || ['0'] || w[list_position(w, 'widget') + 1:], '|') AS after
        FROM (SELECT p_partkey, string_split(p_name || ' widget', ' ') AS w FROM part)""",
)
def insert_at_position(spark, sf_dir):
    words = F.split(F.concat("p_name", F.lit(" widget")), " ")

    def put(position, reference=None):
        return F.array_join(arrays.insert_element(words, "0", position, reference), "|")

    return table(spark, sf_dir, "part").select(
        "p_partkey",
        put("First").alias("at_first"),
        put("Last").alias("at_last"),
        put("Before", "widget").alias("before"),
        put("After", "widget").alias("after"),
    )


@query(
    "P8_insert_column",
    "SELECT s_suppkey, s_name, s_name || '*' AS marked, s_acctbal FROM supplier",
)
def insert_column(spark, sf_dir):
    base = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return columns.insert_column(base, "marked", F.concat("s_name", F.lit("*")), "after", "s_name")


@query("P9_column_index", "SELECT s_suppkey, 1 AS name_at, 3 AS balance_at, 0 AS absent_at FROM supplier")
def column_index(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier")
    wanted = {"name_at": "s_name", "balance_at": "s_acctbal", "absent_at": "nothing"}
    return suppliers.select(
        "s_suppkey", *[F.lit(columns.column_index(suppliers.columns, c)).alias(n) for n, c in wanted.items()]
    )


@query(
    "A4_all_true_arrays",
    """SELECT p_partkey, len(list_filter(string_split(p_name, ' '), lambda w: length(w) <= 4)) = 0 AS all_long FROM part""",
)
def all_true_arrays(spark, sf_dir):
    flags = F.transform(F.split("p_name", " "), lambda w: F.length(w) > 4)
    return table(spark, sf_dir, "part").select("p_partkey", arrays.all_true(flags).alias("all_long"))


@query(
    "A4_all_true_rows",
    """SELECT event_type, bool_and(coalesce(nullif(value, 0) > 0.5, false)) AS all_true FROM events
        GROUP BY event_type""",
)
def all_true_rows(spark, sf_dir):
    flag = F.nullif("value", F.lit(0.0)) > 0.5
    return table(spark, sf_dir, "events").groupBy("event_type").agg(every_true(flag).alias("all_true"))
