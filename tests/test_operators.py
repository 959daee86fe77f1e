"""Filters, aggregations, shifts, row index and checks, against brute force where order matters."""

import random
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from quarryline.operators import aggregates, filters, shift, validation
from quarryline.operators.row_index import add_row_index


@pytest.fixture(scope="module")
def nullable(spark):
    return spark.createDataFrame([("a", 1.0), ("b", 2.0), (None, 3.0), ("a", None)], "k string, v double")


def test_filters(nullable):
    assert rows(filters.filter_equal(nullable, "k", "a").select("k")) == [("a",), ("a",)]
    assert rows(filters.filter_different(nullable, "k", "a").select("k")) == [("b",), (None,)]
    assert rows(filters.filter_different(nullable, "v", "2").select("v")) == [(1.0,), (3.0,), (None,)]
    assert rows(filters.apply_filter(nullable, "k", "multiple_match", {"x": "a", "y": "z"}).select("k")) == [("a",)] * 2
    assert filters.filter_expression(nullable, "v > 1 AND k IS NULL").count() == 1
    with pytest.raises(ValueError):
        filters.apply_filter(nullable, "k", "similar", "a")


def test_filter_names_with_blanks(spark):
    frame = spark.sql("SELECT 'x' AS `Field Name [a.b]`")
    assert filters.filter_equal(frame, "Field Name [a.b]", "x").count() == 1


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_long_lists(spark, monkeypatch, limit):
    monkeypatch.setattr(filters, "IN_LIST_LIMIT", 10)
    kept = filters.filter_multiple_match(spark.range(100), "id", [*range(40), 3, 3])
    assert kept.count() == 40


def _band(values, key, lower, upper):
    at = values.index(key)
    low = 0 if lower is None else max(0, at - lower)
    return values[low : len(values) if upper is None else at + upper + 1]


@pytest.mark.parametrize("top_k", [0, 100])
@pytest.mark.parametrize("lower,upper", [(5, 10), (0, 0), (None, 3), (3, None), (500, 500), (1, 0)])
def test_band(spark, monkeypatch, top_k, lower, upper):
    monkeypatch.setattr(filters, "TOP_K_LIMIT", top_k)
    keys = [(i % 3, i) for i in range(200)]
    random.Random(1).shuffle(keys)
    frame = spark.createDataFrame(keys, "g int, i int").repartition(7)
    order = sorted(keys)
    first = next(k for k in order if k[1] >= 90)
    seen = rows(filters.filter_band(frame, "i >= 90", ["g", "i"], lower, upper))
    assert seen == sorted(_band(order, first, lower, upper), key=repr)


def test_band_without_match_or_bounds(spark):
    frame = spark.range(10)
    assert filters.filter_band(frame, "id > 100", ["id"], 1, 1).count() == 10
    assert filters.filter_band(frame, "id = 1", ["id"]).count() == 10


def test_age(spark):
    frame = spark.sql("SELECT explode(array(DATE '2024-01-01', DATE '2024-01-02', DATE '2024-01-03')) AS d")
    judged = filters.add_age_verdict(frame, "d", date(2024, 1, 2))
    assert [r.verdict for r in judged.orderBy("d").collect()] == ["older", "same", "newer"]
    assert filters.filter_by_age(frame, "d", date(2024, 1, 2), "newer").count() == 1
    with pytest.raises(ValueError):
        filters.filter_by_age(frame, "d", date(2024, 1, 2), "unknown")


def test_min_max(nullable):
    grouped = aggregates.min_max_by_group(nullable, "k", "v", {"v_min": "low"}, sort=True)
    assert grouped.columns == ["k", "low", "v_max"]
    assert [tuple(r) for r in grouped.collect()] == [("a", 1.0, 1.0), ("b", 2.0, 2.0)]


def test_first_current_last(spark):
    data = [(1, "x", "Past"), (2, "c", "Current"), (3, "d", "Current"), (4, "a", "Future")]
    frame = spark.createDataFrame(data, "i int, v string, `Timeline Evaluation` string").repartition(3)
    assert rows(aggregates.first_current_and_last(frame, "v", ["i"])) == [("x", "d", "a")]
    assert rows(aggregates.first_and_last(frame, "v", ["i"])) == [("x", "a")]
    grouped = aggregates.first_and_last(frame, "i", ["v", "i"], ["Timeline Evaluation"])
    assert rows(grouped) == [("Current", 2, 3), ("Future", 4, 4), ("Past", 1, 1)]


def test_every_true(spark):
    frame = spark.createDataFrame([(1, True), (1, None), (2, True), (3, False)], "g int, f boolean")
    seen = rows(frame.groupBy("g").agg(aggregates.every_true(F.col("f")).alias("t")))
    assert seen == [(1, False), (2, True), (3, False)]
    assert frame.where("g > 9").agg(aggregates.every_true(F.col("f"))).first()[0] is True


def test_row_count(spark):
    assert aggregates.row_count(spark.range(7)).first().rows_counted == 7


def _spec(new, original, direction, deviation, empty="-"):
    return {
        "New Column": new, "Original Column": original, "Direction": direction, "Deviation": deviation,
        "Empty Values Replacement": empty,
    }


@pytest.mark.parametrize("direction,expected", [("down", "-ABCDEFGH"), ("up", "BCDEFGHI-")])
@pytest.mark.parametrize("chunk_rows", [1, 2, 4, 1_000_000])
def test_shift_letters(spark, direction, expected, chunk_rows):
    data = list(zip(range(9), "ABCDEFGHI", "ZYXWVUTSR"))
    frame = spark.createDataFrame(data, "row_idx int, Column_A string, Column_Z string").repartition(4)
    moved = shift.add_shifted_columns(
        frame, [_spec("Column_New", "Column_A", direction, 1)], ["row_idx"], chunk_rows=chunk_rows
    )
    assert moved.columns == ["row_idx", "Column_A", "Column_Z", "Column_New"]
    assert "".join(r.Column_New for r in moved.orderBy("row_idx").collect()) == expected


def _brute_shift(ordered: list[dict], specs: list[dict], group: str | None) -> list[dict]:
    for spec in specs:
        offset = shift.signed_offset(spec["Direction"], spec["Deviation"])
        moved = []
        for i, row in enumerate(ordered):
            j = i - offset
            inside = 0 <= j < len(ordered) and (group is None or ordered[j][group] == row[group])
            value = ordered[j][spec["Original Column"]] if inside else None
            moved.append(spec["Empty Values Replacement"] if value is None else str(value))
        for row, value in zip(ordered, moved):
            row[spec["New Column"]] = value
    return ordered


@pytest.mark.parametrize("group", [None, "g"])
@pytest.mark.parametrize("max_group_rows", [1, 10_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_shift_against_brute_force(spark, group, max_group_rows, seed):
    chooser = random.Random(seed)
    hot = ["hot"] * 60 + ["a", "b", None] * 10
    data = [(chooser.choice(hot), i, chooser.choice([None, i, i * 10])) for i in range(150)]
    specs = [_spec("p", "v", "down", 2), _spec("q", "p", "up", 3, "none"), _spec("r", "v", "down", 0)]
    frame = spark.createDataFrame(data, "g string, i int, v int").repartition(5)
    moved = shift.add_shifted_columns(
        frame, specs, ["i"], [group] if group else None, max_group_rows=max_group_rows, chunk_rows=7
    )
    ordered = sorted(data, key=lambda r: ((r[0] or "") if group else "", r[1]))
    expected = _brute_shift([dict(zip("giv", r)) for r in ordered], specs, group)
    assert rows(moved.select("i", "p", "q", "r")) == sorted(
        ((r["i"], r["p"], r["q"], r["r"]) for r in expected), key=repr
    )


def test_row_index(spark):
    values = list(range(500))
    random.Random(3).shuffle(values)
    frame = spark.createDataFrame([(v,) for v in values], "v int").repartition(6)
    for partitions in (None, 1, 9):
        indexed = add_row_index(frame, ["v"], partitions=partitions)
        assert indexed.where("v <> row_idx").count() == 0 and indexed.count() == 500


def test_row_index_of_nothing(spark):
    assert add_row_index(spark.range(0), ["id"]).count() == 0


@pytest.mark.parametrize("max_group_rows", [1, 10_000])
def test_row_index_by_group(spark, max_group_rows):
    data = [("hot" if i % 3 else None, i) for i in range(90)] + [("cold", 1)]
    frame = spark.createDataFrame(data, "g string, i int").repartition(5)
    indexed = add_row_index(frame, ["i"], partition_by=["g"], max_group_rows=max_group_rows, chunk_rows=8)
    expected = []
    for group in ("hot", None, "cold"):
        members = sorted(i for g, i in data if g == group)
        expected += [(group, i, at) for at, i in enumerate(members)]
    assert rows(indexed) == sorted(expected, key=repr)


def test_missing_keys(spark):
    data = [(1, {"a": "1", "b": "2"}), (2, {"a": "1"}), (3, {}), (4, None)]
    frame = spark.createDataFrame(data, "id int, m map<string,string>")
    found = rows(validation.missing_key_violations(frame, "m", ["a", "b"]).select("id", "missing_key"))
    assert found == [(2, "b"), (3, "a"), (3, "b"), (4, "a"), (4, "b")]
    assert rows(validation.complete_rows(frame, "m", ["a", "b"]).select("id")) == [(1,)]
    parsed = spark.sql("""SELECT '{"a": {"x": 1}, "b": [1]}' AS t""").select(validation.json_keys("t").alias("m"))
    assert validation.complete_rows(parsed, "m", ["a", "b"]).count() == 1


@pytest.mark.parametrize("limit", ["-1", "10485760"])
@pytest.mark.parametrize("hot_rows", [5, 10_000])
def test_referential_checks(spark, hot_rows, limit):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        _check_references(spark, hot_rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _check_references(spark, hot_rows):
    data = [("hot", 1)] * 40 + [("known", 2), ("known", 3), ("unknown", 2), (None, 2)] + [("hotmiss", 9)] * 30
    frame = spark.createDataFrame([(g, n, i) for i, (g, n) in enumerate(data)], "g string, n int, i int")
    catalogue = spark.createDataFrame([("hot", 1), ("hot", 1), ("known", 2), (None, 2)], "g string, n int")
    kept = validation.resolvable(frame, catalogue, ["g", "n"], hot_rows)
    left = validation.unresolvable(frame, catalogue, ["g", "n"], hot_rows)
    assert kept.count() == 41 and set(rows(kept.select("g", "n"))) == {("hot", 1), ("known", 2)}
    assert left.count() == 33 and kept.count() + left.count() == frame.count()


def test_non_empty_list(spark):
    frame = spark.createDataFrame([([1], True), ([], False), (None, False)], "a array<int>, expected boolean")
    assert frame.where(validation.non_empty_list("a") != F.col("expected")).count() == 0


def test_literals_that_a_column_cannot_hold(spark):
    frame = spark.createDataFrame([(7, "7"), (8, None), (None, "x")], "k long, t string")
    assert filters.filter_equal(frame, "k", 7.5).count() == 0
    assert filters.filter_equal(frame, "k", "abc").count() == 0
    assert filters.filter_equal(frame, "k", 1 << 70).count() == 0
    assert filters.filter_equal(frame, "k", "7").count() == filters.filter_equal(frame, "k", 7.0).count() == 1
    assert filters.filter_different(frame, "k", 7.5).count() == 3
    assert filters.filter_different(frame, "k", "abc").count() == 3
    assert filters.filter_different(frame, "k", 7).count() == 2


@pytest.mark.parametrize("more", [0, 1200])
def test_list_length_does_not_change_the_answer(spark, more):
    frame = spark.createDataFrame([("true",), ("1.0E7",), ("x",), (None,), ("None",)], "t string")
    values = [None, True, 1e7, *[f"other {i}" for i in range(more)]]
    assert {r.t for r in filters.filter_multiple_match(frame, "t", values).collect()} == {"true", "1.0E7"}
    numbers = spark.range(20).toDF("k")
    wanted = [7.5, 3, "4", 5.0, "abc", *range(100, 100 + more)]
    assert {r.k for r in filters.filter_multiple_match(numbers, "k", wanted).collect()} == {3, 4, 5}


@pytest.mark.parametrize("top_k", [1_000, 1])
def test_band_with_missing_order_keys(spark, monkeypatch, top_k):
    monkeypatch.setattr(filters, "TOP_K_LIMIT", top_k)
    frame = spark.createDataFrame([(None, 1), (None, 2), (3, 3), (4, 4), (5, 5)], "k int, id int")
    band = lambda condition, low, up: sorted(r.id for r in filters.filter_band(frame, condition, ["k", "id"], low, up).collect())
    assert band("id = 3", 2, 1) == [1, 2, 3, 4]
    assert band("id = 2", 5, 2) == [1, 2, 3, 4]
    assert band("id = 1", 2, None) == [1, 2, 3, 4, 5]


def test_not_a_number_counts_as_missing(spark):
    frame = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("b", float("nan"))], "g string, v double")
    found = {tuple(r) for r in aggregates.min_max_by_group(frame, "g", "v").collect()}
    assert found == {("a", 1.0, 1.0), ("b", None, None)}


def test_text_of_numbers(spark):
    values = [12345678.0, 0.0005, 1e-7, 1e20, 2.5, -3.0, float("nan"), None]
    frame = spark.createDataFrame([(v, "1.0") for v in values], "v double, t string")
    from quarryline.functions.text import fill_empty

    found = [tuple(r) for r in frame.select(fill_empty("v", "-"), fill_empty("t", "-")).collect()]
    assert [t for t, _ in found] == ["12345678", "0.0005", "1.0E-7", "1.0E20", "2.5", "-3", "-", "-"]
    assert {t for _, t in found} == {"1.0"}


def test_literals_that_a_type_cannot_hold(spark):
    frame = spark.sql(
        """SELECT DATE '2020-01-01' AS day, true AS yes, 9007199254740992D AS far, CAST(0.1 AS FLOAT) AS tenth, CAST(16777216 AS FLOAT) AS whole,
        TIMESTAMP_NTZ '2020-01-01 05:00:00' AS at, CAST(1.50 AS DECIMAL(9,2)) AS price, '1.0E7' AS text, double('NaN') AS none"""
    )
    held = {
        "day": [date(2020, 1, 1), datetime(2020, 1, 1), "2020-01-01", "2020-1-1"],
        "yes": [True, 1, 1.0, "true", "Yes"],
        "far": [9007199254740992, "9007199254740992", 2.0**53],
        "tenth": [0.1, "0.1"],
        "whole": [16777216],
        "at": [datetime(2020, 1, 1, 5), "2020-01-01 05:00:00", "2020-01-01T05:00"],
        "price": [1.5, "1.50", Decimal("1.500")],
        "text": [1e7, "1.0E7"],
        "none": [float("nan"), "NaN"],
    }
    refused = {
        "day": [datetime(2020, 1, 1, 5), "2020-01-01 00:00:01", 20200101.5, "x", True],
        "yes": [2, 0.5, "maybe", -1],
        "far": [9007199254740993, "9007199254740993", "x", 10**400],
        "whole": [16777217],
        "at": [1577854800, datetime(2020, 1, 1, 5, tzinfo=timezone.utc), "x", date(2020, 1, 1)],
        "price": [1.501, "x"],
        "text": [10_000_000, "1E7"],
    }
    for column, values in held.items():
        for value in values:
            assert filters.filter_equal(frame, column, value).count() == 1, (column, value)
            assert filters.filter_different(frame, column, value).count() == 0, (column, value)
            assert filters.filter_multiple_match(frame, column, [value, None]).count() == 1, (column, value)
    for column, values in refused.items():
        for value in values:
            assert filters.filter_equal(frame, column, value).count() == 0, (column, value)
            assert filters.filter_different(frame, column, value).count() == 1, (column, value)
        many = [*values, *([] if column in ("yes", "day", "at") else range(5, 1100))]
        assert filters.filter_multiple_match(frame, column, many).count() == 0, column


def test_long_lists_hold_any_text(spark):
    frame = spark.createDataFrame([("a\x1fb",), ("a",), ("",)], "t string")
    values = ["a\x1fb", "", *[f"w{i}" for i in range(1200)]]
    assert {r.t for r in filters.filter_multiple_match(frame, "t", values).collect()} == {"a\x1fb", ""}
    assert {r.t for r in filters.filter_multiple_match(frame, "t", values[1:]).collect()} == {""}


@pytest.mark.parametrize(
    ("kind", "few"), [("bigint", 1), ("double", 40), ("date", 40), ("timestamp_ntz", 40), ("timestamp", 40), ("decimal(20,3)", 40), ("string", 40)]
)
def test_wide_bands_by_rank(spark, monkeypatch, kind, few):
    """Ends of a band by histograms, against the rows in order: ties, nulls and all types."""
    monkeypatch.setattr(filters, "TOP_K_LIMIT", 3)
    monkeypatch.setattr(filters, "FEW_ROWS", few)
    monkeypatch.setattr(filters, "BUCKETS", 4)
    rng = random.Random(5)
    numbers = [rng.choice([None, 7, 7, rng.randrange(1000), 10_000]) for _ in range(300)]
    frame = spark.createDataFrame(list(enumerate(numbers)), "id long, n long")
    key = F.col("n").cast(kind)
    if kind in ("date", "timestamp_ntz", "timestamp"):
        key = F.timestamp_seconds(F.col("n") * 86_400).cast(kind)
    elif kind == "string":
        key = F.lpad(F.col("n").cast("string"), 6, "0")
    frame = frame.withColumn("k", key)
    ordered = [i for i, n in sorted(enumerate(numbers), key=lambda p: (p[1] is not None, p[1] or 0, p[0]))]
    for condition, lower, upper in (("n > 500", 200, 20), ("n is null", 0, 100), ("id = 3", None, 30)):
        matching = [i for i in ordered if ((numbers[i] or 0) > 500 if condition == "n > 500" else i == 3 if condition == "id = 3" else numbers[i] is None)]
        at = ordered.index(matching[0])
        wanted = ordered[0 if lower is None else max(0, at - lower) : len(ordered) if upper is None else at + upper + 1]
        found = filters.filter_band(frame, condition, ["k", "id"], lower, upper)
        assert sorted(r.id for r in found.collect()) == sorted(wanted), (condition, lower, upper)


def test_wide_bands_move_no_rows(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(filters, "FEW_ROWS", 50)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    day = lines.selectExpr("percentile(unix_date(CAST(l_shipdate AS DATE)), 0.5)").first()[0]
    band = filters.filter_band(lines, f"unix_date(CAST(l_shipdate AS DATE)) > {day}", ["l_shipdate", "l_orderkey", "l_linenumber"], 1500, 2000)
    assert "Exchange" not in band._jdf.queryExecution().executedPlan().toString()
    assert band.count() == 3501


MIXED = [
    ("a", None, None, 5, "m"), ("a", None, 2, 6, "n"), ("a", 1, None, 7, "o"), ("a", 1, -(1 << 63), 8, "p"),
    ("a", 9, (1 << 63) - 1, 9, "q"), ("a", 9, 3, 10, None), ("b", -5, 1, 11, "r"), ("b", -5, 2, None, "s"),
    (None, 4, 4, 12, "t"), (None, 3, 9, 13, "prefix of eight and u"), (None, None, -7, 14, "prefix of eight and v"),
]


@pytest.mark.parametrize("kind", ["int", "bigint", "date", "timestamp", "timestamp_ntz", "double", "string", "decimal(30,4)"])
@pytest.mark.parametrize("value", ["v", "t"])
@pytest.mark.parametrize("grouped", [True, False])
def test_ends_of_mixed_orders(spark, kind, value, grouped):
    made = "x" if kind not in ("date", "timestamp", "timestamp_ntz") else "date_add(DATE '2020-01-01', x)"
    frame = spark.createDataFrame(MIXED, "g string, x int, y bigint, v int, t string")
    frame = frame.selectExpr("g", f"CAST({made} AS {kind}) AS x", "y", "v", "t", "v % 2 = 0 AS even").repartition(3)
    frame = frame.withColumn("Timeline Evaluation", F.when(F.col("even"), "Current").otherwise("Past"))
    groups = ["g"] if grouped else []
    number = (lambda x: str(x)) if kind == "string" else float
    order = lambda r: tuple((k is not None, k) for k in (None if r[1] is None else number(r[1]), r[2]))
    wanted = []
    for g in {r[0] for r in MIXED} if grouped else {None}:
        mine = sorted((r for r in MIXED if not grouped or r[0] == g), key=order)
        pick = (lambda r: r[3]) if value == "v" else (lambda r: r[4])
        current = [pick(r) for r in mine if r[3] is not None and r[3] % 2 == 0 and pick(r) is not None]
        wanted.append((*([g] if grouped else []), pick(mine[0]), max(current, default=None), pick(mine[-1])))
    found = aggregates.first_current_and_last(frame, value, ["x", "y"], groups)
    assert rows(found) == sorted(wanted, key=repr)
    short = aggregates.first_and_last(frame, value, ["x", "y"], groups)
    assert rows(short) == sorted(((*w[:-2], w[-1]) for w in wanted), key=repr)


def test_ends_by_one_order_leave_rows_without_it_out(spark):
    frame = spark.createDataFrame([("a", None, "x"), ("a", "k", "y"), ("a", "kk", "z"), ("b", None, "w")], "g string, o string, v string")
    assert rows(aggregates.first_and_last(frame, "v", ["o"], ["g"])) == [("a", "y", "z"), ("b", None, None)]
    assert rows(aggregates.first_and_last(frame.limit(0), "v", ["o"])) == [(None, None)]


def test_smallest_and_largest_text(spark):
    words = ["", "same start 1", "same start 2", "same start", "über", "zz", "z"]
    frame = spark.createDataFrame([(i % 2, w) for i in range(2) for w in words] + [(5, None)], "g int, `a.b` string")
    found = aggregates.min_max_by_group(frame, "g", "a.b")
    assert rows(found) == [(0, "", "über"), (1, "", "über"), (5, None, None)]
    few = aggregates.min_max_by_group(frame.where("`a.b` LIKE 'same%'"), ["g"], "a.b")
    assert rows(few) == [(0, "same start", "same start 2"), (1, "same start", "same start 2")]
