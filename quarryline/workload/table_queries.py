"""Filters, aggregations, shifts, row index, unions and checks."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.functions.dates import add_timeline_evaluation
from quarryline.operators import aggregates, columns, filters, shift, validation
from quarryline.operators.row_index import add_row_index
from quarryline.workload.column_queries import INTERVALS_SQL, REFERENCE, TIMELINE_SQL, _intervals
from quarryline.workload.registry import query, table

# --------------------------------------------------------------------------- filters

# The tables have no empty values, so one segment is blanked out to show what filters do to them.
_SEGMENTS_SQL = "(SELECT c_custkey, nullif(c_mktsegment, 'MACHINERY') AS c_mktsegment FROM customer)"


def _segments(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    return customers.select("c_custkey", F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("c_mktsegment"))


@query("F1_filter_equal", f"SELECT * FROM {_SEGMENTS_SQL} WHERE c_mktsegment = 'FURNITURE'")
def filter_equal(spark, sf_dir):
    return filters.apply_filter(_segments(spark, sf_dir), "c_mktsegment", "equal", "FURNITURE")


@query("F1_filter_equal_number", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey = 7")
def filter_equal_number(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return filters.apply_filter(orders, "o_custkey", "equal", "7")


@query("F2_filter_different", f"SELECT * FROM {_SEGMENTS_SQL} WHERE c_mktsegment IS DISTINCT FROM 'FURNITURE'")
def filter_different(spark, sf_dir):
    return filters.apply_filter(_segments(spark, sf_dir), "c_mktsegment", "different", "FURNITURE")


@query("F3_filter_multiple_match", f"SELECT * FROM {_SEGMENTS_SQL} WHERE c_mktsegment IN ('FURNITURE', 'BUILDING')")
def filter_multiple_match(spark, sf_dir):
    wanted = {"Chairs": "FURNITURE", "Houses": "BUILDING"}
    return filters.apply_filter(_segments(spark, sf_dir), "c_mktsegment", "multiple_match", wanted)


@query(
    "F3_filter_long_list",
    "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_partkey BETWEEN 10 AND 1500",
)
def filter_long_list(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return filters.filter_multiple_match(lines, "l_partkey", [str(k) for k in range(10, 1501)])


@query(
    "F5_band_around_row",
    """WITH numbered AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) AS i FROM orders),
        ref AS (SELECT min(i) AS r FROM numbered WHERE o_totalprice > 200000)
        SELECT o_orderkey, o_totalprice FROM numbered, ref WHERE i BETWEEN r - 5 AND r + 10""",
)
def band_around_row(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return filters.filter_band(orders, "o_totalprice > 200000", ["o_orderkey"], lower=5, upper=10)


@query(
    "F5_band_two_keys",
    """WITH numbered AS (SELECT event_id, ts, row_number() OVER (ORDER BY event_type, event_id) AS i FROM events),
        ref AS (SELECT min(i) AS r FROM numbered WHERE ts >= TIMESTAMP '2024-01-15')
        SELECT event_id, ts FROM numbered, ref WHERE i BETWEEN r - 40 AND r + 3""",
)
def band_two_keys(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    near = filters.filter_band(events, "ts >= '2024-01-15'", ["event_type", "event_id"], lower=40, upper=3)
    return near.select("event_id", "ts")


@query(
    "F5_band_open_side",
    """SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderkey <= 4 +
        (SELECT min(o_orderkey) FROM orders WHERE o_orderdate >= TIMESTAMP '2001-07-01')""",
)
def band_open_side(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return filters.filter_band(orders, "o_orderdate >= '2001-07-01'", ["o_orderkey"], upper=4)


@query(
    "F6_expression_filter",
    "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity * l_discount > 2 AND l_returnflag <> 'N'",
)
def expression_filter(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    kept = filters.filter_expression(lines, "l_quantity * l_discount > 2 AND l_returnflag <> 'N'")
    return kept.select("l_orderkey", "l_quantity")


_BARRIER = datetime(2024, 1, 15, 0, 9, 58)


@query(
    "F7_age_verdict",
    """SELECT event_id, CASE WHEN date_trunc('day', ts) > TIMESTAMP '2024-01-15' THEN 'newer'
        WHEN date_trunc('day', ts) = TIMESTAMP '2024-01-15' THEN 'same' ELSE 'older' END AS verdict FROM events""",
)
def age_verdict(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("ts", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    return filters.add_age_verdict(events, "ts", datetime(2024, 1, 15)).select("event_id", "verdict")


@query("F7_filter_by_age", "SELECT event_id, ts FROM events WHERE ts < TIMESTAMP '2024-01-15 00:09:58'")
def filter_by_age(spark, sf_dir):
    return filters.filter_by_age(table(spark, sf_dir, "events"), "ts", _BARRIER, "older").select("event_id", "ts")


def _properties():
    """The JSON properties of an event, without ``k`` where the event is a click."""
    return F.when(F.col("event_type") == "click", F.lit('{"other": 1}')).otherwise(F.col("props"))


_PROPERTIES_SQL = """(SELECT event_id, CASE WHEN event_type = 'click' THEN '{"other": 1}' ELSE props END AS p
    FROM events)"""


@query(
    "F8_missing_keys",
    f"""SELECT event_id, 'k' AS missing_key FROM {_PROPERTIES_SQL} WHERE json_extract(p, '$.k') IS NULL
        UNION ALL SELECT event_id, 'other' FROM {_PROPERTIES_SQL} WHERE json_extract(p, '$.other') IS NULL""",
)
def missing_keys(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", validation.json_keys(_properties()).alias("p"))
    return validation.missing_key_violations(events, "p", ["k", "other"]).drop("p")


@query("F8_complete_rows", f"SELECT event_id FROM {_PROPERTIES_SQL} WHERE json_extract(p, '$.k') IS NOT NULL")
def complete_rows(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", validation.json_keys(_properties()).alias("p"))
    return validation.complete_rows(events, "p", ["k"]).select("event_id")


_CATALOGUE_SQL = "(SELECT c_custkey, c_nationkey FROM customer WHERE c_acctbal > 3000)"


def _catalogue(spark, sf_dir):
    rich = table(spark, sf_dir, "customer").where("c_acctbal > 3000")
    return rich.select(F.col("c_custkey").alias("o_custkey"))


@query(
    "F9_resolvable",
    f"SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM {_CATALOGUE_SQL})",
)
def resolvable(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return validation.resolvable(orders, _catalogue(spark, sf_dir), ["o_custkey"])


@query(
    "F9_unresolvable",
    f"SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM {_CATALOGUE_SQL})",
)
def unresolvable(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return validation.unresolvable(orders, _catalogue(spark, sf_dir), ["o_custkey"])


@query(
    "F9_resolvable_hot_keys",
    "SELECT event_id, event_type FROM events WHERE event_type IN (SELECT event_type FROM events WHERE value > 400)",
)
def resolvable_hot_keys(spark, sf_dir):
    """Five keys, each with a large share of the rows."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    catalogue = table(spark, sf_dir, "events").where("value > 400").select("event_type")
    return validation.resolvable(events, catalogue, ["event_type"], hot_rows=1_000)


@query(
    "F10_non_empty_list",
    "SELECT p_partkey, len(list_filter(string_split(p_name, ' '), lambda w: length(w) > 5)) > 0 AS ok FROM part",
)
def non_empty_list(spark, sf_dir):
    long_words = F.filter(F.split("p_name", " "), lambda w: F.length(w) > 5)
    return table(spark, sf_dir, "part").select("p_partkey", validation.non_empty_list(long_words).alias("ok"))


# --------------------------------------------------------------------------- aggregations


@query(
    "A1_min_max_by_group",
    "SELECT l_orderkey, min(l_shipdate) AS l_shipdate_min, max(l_shipdate) AS l_shipdate_max FROM lineitem GROUP BY 1",
)
def min_max_by_group(spark, sf_dir):
    return aggregates.min_max_by_group(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_shipdate")


@query(
    "A1_min_max_without_empty_keys",
    f"""SELECT c_mktsegment, min(c_custkey) AS first_key, max(c_custkey) AS last_key FROM {_SEGMENTS_SQL}
        WHERE c_mktsegment IS NOT NULL GROUP BY 1""",
)
def min_max_without_empty_keys(spark, sf_dir):
    names = {"c_custkey_min": "first_key", "c_custkey_max": "last_key"}
    return aggregates.min_max_by_group(_segments(spark, sf_dir), ["c_mktsegment"], "c_custkey", names, sort=True)


@query(
    "A2_first_and_last",
    "SELECT arg_min(o_totalprice, o_orderkey) AS first, arg_max(o_totalprice, o_orderkey) AS last FROM orders",
)
def first_and_last(spark, sf_dir):
    return aggregates.first_and_last(table(spark, sf_dir, "orders"), "o_totalprice", ["o_orderkey"])


@query(
    "A2_first_and_last_by_group",
    """SELECT event_type, arg_min(value, (ts, event_id)) AS first, arg_max(value, (ts, event_id)) AS last
        FROM events GROUP BY event_type""",
)
def first_and_last_by_group(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return aggregates.first_and_last(events, "value", ["ts", "event_id"], ["event_type"])


@query(
    "A3_first_current_and_last",
    f"""SELECT arg_min("End Date", l_orderkey) AS first,
        max(CASE WHEN t = 'Current' THEN "End Date" END) AS current, arg_max("End Date", l_orderkey) AS last
        FROM (SELECT *, {TIMELINE_SQL} AS t FROM {INTERVALS_SQL})""",
)
def first_current_and_last(spark, sf_dir):
    placed = add_timeline_evaluation(_intervals(spark, sf_dir), REFERENCE)
    return aggregates.first_current_and_last(placed, "End Date", ["l_orderkey"])


@query("A5_row_count", "SELECT count(*) AS rows_counted FROM lineitem")
def row_count(spark, sf_dir):
    return aggregates.row_count(table(spark, sf_dir, "lineitem"))


# --------------------------------------------------------------------------- shifts and index


def _spec(name: str, original: str, direction: str, deviation: int) -> dict:
    return {
        "New Column": name, "Original Column": original, "Direction": direction, "Deviation": deviation,
        "Empty Values Replacement": "-",
    }


@query(
    "W1_shift_down_by_group",
    """SELECT o_orderkey, coalesce(lag(o_orderstatus) OVER w, '-') AS previous,
        coalesce(CAST(lag(o_orderkey, 2) OVER w AS VARCHAR), '-') AS before_that
        FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)""",
)
def shift_down_by_group(spark, sf_dir):
    specs = [_spec("previous", "o_orderstatus", "down", 1), _spec("before_that", "o_orderkey", "down", 2)]
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    moved = shift.add_shifted_columns(orders, specs, ["o_orderkey"], ["o_custkey"])
    return moved.select("o_orderkey", "previous", "before_that")


@query(
    "W1_shift_down_hot_groups",
    """SELECT event_id, coalesce(CAST(lag(user_id) OVER w AS VARCHAR), '-') AS previous,
        coalesce(CAST(lead(user_id, 3) OVER w AS VARCHAR), '-') AS following
        FROM events WINDOW w AS (PARTITION BY event_type ORDER BY event_id)""",
)
def shift_down_hot_groups(spark, sf_dir):
    """Big groups count as hot here, so their rows take the way that never gives a group to one task."""
    specs = [_spec("previous", "user_id", "down", 1), _spec("following", "user_id", "up", 3)]
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    moved = shift.add_shifted_columns(
        events, specs, ["event_id"], ["event_type"], max_group_rows=1_000, chunk_rows=1_000
    )
    return moved.select("event_id", "previous", "following")


@query(
    "W1_shift_down_global",
    """SELECT o_orderkey, coalesce(lag(o_orderpriority) OVER (ORDER BY o_orderkey), '-') AS previous FROM orders""",
)
def shift_down_global(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    moved = shift.add_shifted_columns(
        orders, [_spec("previous", "o_orderpriority", "down", 1)], ["o_orderkey"], chunk_rows=10_000
    )
    return moved.select("o_orderkey", "previous")


@query(
    "W2_shift_up_by_group",
    """SELECT o_orderkey, coalesce(lead(o_orderstatus, 2) OVER (PARTITION BY o_custkey ORDER BY o_orderkey), '-')
        AS following FROM orders""",
)
def shift_up_by_group(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    moved = shift.add_shifted_columns(
        orders, [_spec("following", "o_orderstatus", "up", 2)], ["o_orderkey"], ["o_custkey"]
    )
    return moved.select("o_orderkey", "following")


@query(
    "W2_shift_up_global",
    "SELECT o_orderkey, coalesce(lead(o_orderstatus, 2) OVER (ORDER BY o_orderkey), '-') AS following FROM orders",
)
def shift_up_global(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    moved = shift.add_shifted_columns(
        orders, [_spec("following", "o_orderstatus", "up", 2)], ["o_orderkey"], chunk_rows=10_000
    )
    return moved.select("o_orderkey", "following")


@query(
    "W3_shift_chain",
    """SELECT o_orderkey, a, coalesce(lag(a) OVER w, '-') AS b, coalesce(lead(a, 2) OVER w, '-') AS c
        FROM (SELECT o_orderkey, o_custkey, coalesce(lag(o_orderstatus) OVER v, '-') AS a FROM orders
        WINDOW v AS (PARTITION BY o_custkey ORDER BY o_orderkey))
        WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)""",
)
def shift_chain(spark, sf_dir):
    specs = [_spec("a", "o_orderstatus", "down", 1), _spec("b", "a", "down", 1), _spec("c", "a", "up", 2)]
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    moved = shift.add_shifted_columns(orders, specs, ["o_orderkey"], ["o_custkey"])
    return moved.select("o_orderkey", "a", "b", "c")


@query(
    "W4_row_index",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_idx FROM orders",
)
def row_index(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return add_row_index(orders, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "row_idx")


@query(
    "W4_row_index_by_group",
    """SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS row_idx FROM orders""",
)
def row_index_by_group(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return add_row_index(orders, ["o_orderkey"], partition_by=["o_custkey"]).select("o_orderkey", "row_idx")


@query(
    "W4_row_index_hot_groups",
    "SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS row_idx FROM events",
)
def row_index_hot_groups(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    indexed = add_row_index(
        events, ["event_id"], partition_by=["event_type"], max_group_rows=1_000, chunk_rows=1_000
    )
    return indexed.select("event_id", "row_idx")


# --------------------------------------------------------------------------- union


@query(
    "U1_union_by_name",
    """SELECT r_regionkey AS key, r_name AS name, CAST(NULL AS INTEGER) AS region FROM region
        UNION ALL SELECT n_nationkey, n_name, n_regionkey FROM nation""",
)
def union_by_name(spark, sf_dir):
    regions = columns.rename_columns(table(spark, sf_dir, "region"), {"r_regionkey": "key", "r_name": "name"})
    nations = columns.rename_columns(
        table(spark, sf_dir, "nation"), {"n_nationkey": "key", "n_name": "name", "n_regionkey": "region"}
    )
    return columns.union_tables([regions, nations])


# ----------------------------------------------------------- values beyond the ordinary


@query("F1_filter_equal_fraction", "SELECT o_orderkey FROM orders WHERE false")
def filter_equal_fraction(spark, sf_dir):
    return filters.filter_equal(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 7.5)


@query("F1_filter_equal_text_on_number", "SELECT o_orderkey FROM orders WHERE false")
def filter_equal_text_on_number(spark, sf_dir):
    return filters.filter_equal(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", "abc")


@query("F2_filter_different_fraction", "SELECT o_orderkey FROM orders")
def filter_different_fraction(spark, sf_dir):
    return filters.filter_different(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 7.5)


@query(
    "F1_filter_equal_inexact_literals",
    """SELECT 'date' AS kind, o_orderkey FROM orders WHERE CAST(o_orderdate AS TIMESTAMP) = TIMESTAMP '1995-01-01 05:00:00'
        UNION ALL SELECT 'day', o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1995-01-01'
        UNION ALL SELECT 'one', o_orderkey FROM orders WHERE o_orderkey % 2 = 1
        UNION ALL SELECT 'double', o_orderkey FROM orders
            WHERE CAST(CAST(o_orderkey AS DOUBLE) + 9007199254740000 AS HUGEINT) = 9007199254740993""",
)
def filter_equal_inexact_literals(spark, sf_dir):
    """An hour on a date, two on a truth value, a number between two doubles: no rows; exact literals: theirs."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_orderdate").cast("date").alias("day"),
        (F.col("o_orderkey") % 2 == 1).alias("odd"),
        (F.col("o_orderkey").cast("double") + 9007199254740000.0).alias("far"),
    )
    wanted = [
        ("date", "day", datetime(1995, 1, 1, 5)),
        ("day", "day", datetime(1995, 1, 1)),
        ("two", "odd", 2),
        ("one", "odd", 1),
        ("double", "far", 9007199254740993),
    ]
    parts = [
        filters.filter_equal(orders, column, value).select(F.lit(kind).alias("kind"), "o_orderkey") for kind, column, value in wanted
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "F2_F3_filter_inexact_literals",
    """SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) IN (DATE '1995-01-01', DATE '1995-02-01')""",
)
def filter_inexact_literals(spark, sf_dir):
    """Other than an hour of a day is every date; in a list, an hour matches none."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    every = filters.filter_different(orders, "day", datetime(1995, 2, 1, 5))
    wanted = [datetime(1995, 1, 1), date(1995, 2, 1), "1995-03-01 01:00:00", datetime(1995, 4, 1, 0, 0, 1), None]
    return filters.filter_multiple_match(every, "day", wanted).select("o_orderkey")


@query(
    "F3_filter_long_list_of_kinds",
    """SELECT o_orderkey, planted FROM (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'true' WHEN 1 THEN '1.0E7'
        WHEN 2 THEN 'None' ELSE 'x' END AS planted FROM orders) WHERE planted IN ('true', '1.0E7')""",
)
def filter_long_list_of_kinds(spark, sf_dir):
    key = F.col("o_orderkey") % 4
    planted = F.when(key == 0, "true").when(key == 1, "1.0E7").when(key == 2, "None").otherwise("x")
    frame = table(spark, sf_dir, "orders").select("o_orderkey", planted.alias("planted"))
    return filters.filter_multiple_match(frame, "planted", [None, True, 1e7, *[f"other {i}" for i in range(1200)]])


_BAND_NULLS = """WITH planted AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN o_custkey END AS part FROM orders),
    placed AS (SELECT *, row_number() OVER (ORDER BY part NULLS FIRST, o_orderkey) AS n FROM planted),
    here AS (SELECT min(n) AS spot FROM placed WHERE part >= 5)
    SELECT o_orderkey, part FROM placed, here WHERE n BETWEEN spot - {width} AND spot + {width}"""


def _register_band_null_keys(name, width):
    @query(name, _BAND_NULLS.format(width=width))
    def band_null_keys(spark, sf_dir):
        part = F.when(F.col("o_orderkey") % 3 > 0, F.col("o_custkey"))
        frame = table(spark, sf_dir, "orders").select("o_orderkey", part.alias("part"))
        return filters.filter_band(frame, "part >= 5", ["part", "o_orderkey"], lower=width, upper=width)


_register_band_null_keys("F5_band_null_keys", 100)
_register_band_null_keys("F5_wide_band_null_keys", 2_000)


@query(
    "A1_min_max_nan",
    """SELECT o_custkey, min(v) AS v_min, max(v) AS v_max FROM (SELECT o_custkey,
        CASE WHEN o_orderkey % 5 > 0 THEN o_totalprice END AS v FROM orders) GROUP BY o_custkey""",
)
def min_max_nan(spark, sf_dir):
    planted = F.when(F.col("o_orderkey") % 5 > 0, F.col("o_totalprice")).otherwise(F.lit(float("nan")))
    frame = table(spark, sf_dir, "orders").select("o_custkey", planted.alias("v"))
    return aggregates.min_max_by_group(frame, "o_custkey", "v")
