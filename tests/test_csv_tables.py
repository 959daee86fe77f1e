"""CSV files with many headers, with fields over line ends in several splits, and with wide numbers."""

import csv
import io
import random
from decimal import Decimal

import pytest

from quarryline.sources import csv_tables, files
from quarryline.sources.formats import SOURCE_FILE_COLUMN


def written(rows, separator=",", end="\n"):
    out = io.StringIO(newline="")
    csv.writer(out, delimiter=separator, lineterminator=end).writerows(rows)
    return out.getvalue().encode()


@pytest.fixture
def small_splits(spark):
    """Files cut every few hundred bytes."""
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for key in held:
        spark.conf.set(key, "400")
    yield
    for key, value in held.items():
        spark.conf.set(key, value)


def random_rows(count, seed):
    rng = random.Random(seed)
    pieces = ["a", 'say "x"', "two\nlines", ",", "\n\n", "é\r\nb", '"', "5", "x" * 90, "long\n" * 120 if rng.random() < 2 else "", "plain", 'b"c', " ", '""\n"']
    rows = []
    for i in range(count):
        rows.append([str(i), *("".join(rng.choices(pieces, weights=[9, 2, 2, 1, 1, 1, 1, 5, 3, 0.2, 9, 2, 2, 1], k=rng.randint(0, 3))) for _ in range(2))])
    return rows


@pytest.mark.parametrize(("separator", "end"), [(",", "\n"), ("|", "\n"), (";", "\r\n")])
def test_fields_over_line_ends_in_many_splits(spark, small_splits, tmp_path, separator, end):
    wanted = set()
    for name in ("one.csv", "two.csv"):
        rows = random_rows(400, name)
        (tmp_path / name).write_bytes(written([["id", "first", "second"], *rows], separator, end))
        # Empty fields are missing values.
        wanted |= {(name, *(v or None for v in row)) for row in rows}
    spec = {"format": "csv", "file list": [str(tmp_path / "*.csv")], "field delimiter": separator, "schema": "id string, first string, second string"}
    frame = files.load(spark, spec)
    assert frame.rdd.getNumPartitions() > 20
    seen = {(r[SOURCE_FILE_COLUMN], r.id, r["first"], r["second"]) for r in frame.collect()}
    assert seen == wanted
    lines = csv_tables._lines(spark, [str(tmp_path / "*.csv")])
    assert csv_tables.splits_inside(lines, separator).count() > 5


def test_one_long_field_over_many_splits(spark, small_splits, tmp_path):
    rows = [["1", "word\n" * 900], ["2", "end"], ["3", "\n" * 700 + '"' * 50]]
    (tmp_path / "a.csv").write_bytes(written([["id", "text"], *rows]))
    seen = files.load(spark, {"format": "csv", "file list": [str(tmp_path)], "schema": "id string, text string"})
    assert sorted((r.id, r.text) for r in seen.collect()) == sorted(map(tuple, rows))


def test_quotes_inside_plain_fields_open_nothing(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,size\n1,5" pipe\n2,plain\n3,"a ""b"""\n\n4,x"y"z\n')
    spec = {"format": "csv", "file list": [str(tmp_path)]}
    assert not csv_tables._has_multi_line_fields(spark, [str(tmp_path)], spec)
    seen = {(r.id, r.size) for r in files.load(spark, spec).collect()}
    assert seen == {(1, '5" pipe'), (2, "plain"), (3, 'a "b"'), (4, 'x"y"z')}


@pytest.mark.parametrize("line", ["", "a,b", '"', '"a', '"a""', '"a"",b"', 'a"b', '"a"x,"y', '"a","b', 'x,"', '"a"",', 'a,"b""c",d', '"a"b"c,d', '"",""'])
def test_lines_that_end_inside_a_field(spark, line):
    inside = csv_tables.ends_inside(line, False, ",")
    frame = spark.createDataFrame([(line,)], "value string")
    assert frame.select(csv_tables._closed(frame["value"], ",")).first()[0] is not inside


def test_fifty_headers_are_one_scan(spark, tmp_path):
    wanted = set()
    for i in range(50):
        names = ["id", f"own{i}", "shared"]
        random.Random(i).shuffle(names)
        row = {"id": str(i), f"own{i}": f"o{i}", "shared": f"s{i}"}
        (tmp_path / f"{i}.csv").write_text(",".join(names) + "\n" + ",".join(row[n] for n in names) + "\n")
        wanted.add((i, f"o{i}", f"s{i}", f"{i}.csv"))
    frame = files.load(spark, {"format": "csv", "file list": [str(tmp_path)]})
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 2 and plan.count("parquet") == 1  # the files, and the table of headers
    seen = {(r["id"], next(r[f"own{i}"] for i in range(50) if r[f"own{i}"] is not None), r["shared"], r[SOURCE_FILE_COLUMN]) for r in frame.collect()}
    assert seen == wanted
    assert set(frame.columns) == {"id", "shared", *(f"own{i}" for i in range(50)), SOURCE_FILE_COLUMN}


def test_headers_by_name_with_line_ends_in_fields(spark, small_splits, tmp_path):
    (tmp_path / "a.csv").write_bytes(written([["x", "y"], *[[str(i), f"l{i}\nm"] for i in range(60)]]))
    (tmp_path / "b.csv").write_bytes(written([["y\nz", "y", "x"], *[["0", f"b{i}\n", str(i)] for i in range(60)]]))
    (tmp_path / "empty.csv").write_bytes(b"")
    (tmp_path / "bare.csv").write_bytes(b"\n\nx\n")
    frame = files.load(spark, {"format": "csv", "file list": [str(tmp_path)]})
    assert set(frame.columns) == {"x", "y", "y\nz", SOURCE_FILE_COLUMN}
    seen = {(r["x"], r["y"], r["y\nz"]) for r in frame.collect()}
    assert seen == {(i, f"l{i}\nm", None) for i in range(60)} | {(i, f"b{i}\n", 0) for i in range(60)}


def test_names_of_headers():
    assert csv_tables.column_names('a,"b ""c""",,a,A', ",") == ["a0", 'b "c"', "_c2", "a3", "A4"]
    assert csv_tables.column_names("a||b", "||") == ["a", "b"]


def test_wide_numbers_beside_fractions_stay_apart(spark, tmp_path):
    ids = ["12345678901234567891", "12345678901234567892"]
    cases = {
        "exact": [*ids, "1.5"], "long": [*ids, "0." + "1" * 30], "power": [*ids, "1e5"], "small": ["1", "2", "1.5"], "missing": [*ids, "NA"],
    }
    for name, values in cases.items():
        (tmp_path / f"{name}.csv").write_text("\n".join(["v", *values]) + "\n")
    load = lambda name: files.load(spark, {"format": "csv", "file list": [str(tmp_path / f"{name}.csv")]}).select("v")
    assert load("exact").dtypes == [("v", "decimal(38,1)")]
    assert {r.v for r in load("exact").collect()} == {Decimal(v) for v in cases["exact"]}
    assert {r.v for r in load("long").collect()} == set(cases["long"])
    assert {r.v for r in load("power").collect()} == set(cases["power"])
    assert load("small").dtypes == [("v", "double")]
    assert {r.v for r in load("missing").collect()} == {Decimal(ids[0]), Decimal(ids[1]), None}
