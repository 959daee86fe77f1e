"""Sources and sinks: round trips, drifting files, workbooks, statistics."""

import gzip
import hashlib
import json
import zipfile
from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from quarryline import runtime
from quarryline.functions.dates import moment_literal
from quarryline.sources import files, formats, sinks, workbook
from quarryline.sources.formats import SOURCE_FILE_COLUMN


@pytest.fixture(scope="module")
def mixed(spark):
    data = [
        (1, 1.5, "plain", True, datetime(2024, 2, 29, 1, 2, 3), date(2024, 2, 29)),
        (2, None, 'quote " comma , <tag> & é', False, None, None),
        (None, -0.25, "two\nlines", None, datetime(1999, 1, 1), date(1999, 1, 1)),
    ]
    schema = "n bigint, x double, s string, b boolean, t timestamp_ntz, d date"
    return spark.createDataFrame(data, schema)


def _back(spark, spec):
    return files.load(spark, {**spec, "file list": [spec["name"]]})


def test_parquet_and_pickle_keep_everything(spark, mixed, tmp_path):
    for chosen, codecs in (
        ("parquet", ["snappy", "gzip", "none", "zstd", "infer"]),
        ("pickle", ["none", "gzip", "bz2", "xz", "zip"]),
    ):
        for codec in codecs:
            spec = {"format": chosen, "name": str(tmp_path / f"{chosen}.{codec}"), "compression": codec}
            sinks.save(mixed, spec)
            loaded = _back(spark, spec)
            assert loaded.columns == [*mixed.columns, SOURCE_FILE_COLUMN]
            assert rows(loaded.drop(SOURCE_FILE_COLUMN)) == rows(mixed)


def test_pickle_keeps_rich_types(spark, tmp_path):
    frame = spark.sql(
        "SELECT 9007199254740993 AS big, CAST(1.10 AS DECIMAL(10,2)) AS m, array(1, NULL) AS a, "
        "named_struct('x', 1) AS st, CAST(NULL AS BIGINT) AS nothing"
    )
    spec = {"format": "pickle", "name": str(tmp_path / "rich.pickle")}
    sinks.save(frame, spec)
    row = _back(spark, spec).first()
    assert (row.big, row.m, row.a, row.st.x, row.nothing) == (9007199254740993, Decimal("1.10"), [1, None], 1, None)
    assert row[SOURCE_FILE_COLUMN] == "rich.pickle"


def test_csv_and_json(spark, mixed, tmp_path):
    flat = mixed.drop("b").withColumn("s", F.replace("s", F.lit("\n"), F.lit(" ")))
    for spec in (
        {"format": "csv", "field delimiter": "|"}, {"format": "CSV", "compression": "gzip"},
        {"format": "json"}, {"format": "json", "compression": "bz2"},
    ):
        spec = {**spec, "name": str(tmp_path / f"{spec['format']}-{len(spec)}-{spec.get('compression')}")}
        sinks.save(flat, spec)
        loaded = _back(spark, {**spec, "schema": flat.schema})
        assert rows(loaded.drop(SOURCE_FILE_COLUMN)) == rows(flat)


def test_csv_inference_and_union_of_drifting_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,x\n2,y\n")
    (tmp_path / "b.csv").write_text("extra,id,name\n2.5,3,z\n")
    (tmp_path / "c.csv").write_text("id,name\nfour,w\n")
    (tmp_path / "empty.csv").write_text("")
    loaded = files.ingest(spark, str(tmp_path / "*.csv"), {"format": "csv"})
    assert rows(loaded.select("id", "name", "extra", SOURCE_FILE_COLUMN)) == [
        ("1", "x", None, "a.csv"), ("2", "y", None, "a.csv"), ("3", "z", 2.5, "b.csv"), ("four", "w", None, "c.csv"),
    ]


def test_csv_values(spark, tmp_path):
    """Missing texts, doubled quotes, fields over several lines, and what counts as a number."""
    (tmp_path / "v.csv").write_text(
        'n,x,b,s,d,big\n1,1e3,True,"say ""hi"", you",2024-01-01,99999999999999999999\n'
        'NA, .5 ,false,"two\nlines",NULL,1\n 007,-inf,,1.0d,2024-01-02,2\n'
    )
    spec = {"format": "csv", "file list": [str(tmp_path / "v.csv")]}
    loaded = files.load(spark, spec).drop(SOURCE_FILE_COLUMN)
    assert [k for _, k in loaded.dtypes] == ["bigint", "double", "boolean", "string", "string", "decimal(38,0)"]
    assert rows(loaded) == [
        (1, 1000.0, True, 'say "hi", you', "2024-01-01", Decimal(10**20 - 1)),
        (7, float("-inf"), None, "1.0d", "2024-01-02", Decimal(2)),
        (None, 0.5, False, "two\nlines", None, Decimal(1)),
    ]
    assert files.load(spark, {**spec, "multi line": False}).count() == 4


def test_csv_column_kinds(spark, tmp_path):
    (tmp_path / "k.csv").write_text("none,mixed,flag,text\n,1,TRUE,true\nNA,2.5,false,1\n")
    loaded = files.load(spark, {"format": "csv", "file list": [str(tmp_path / "k.csv")]}).drop(SOURCE_FILE_COLUMN)
    assert loaded.dtypes == [("none", "double"), ("mixed", "double"), ("flag", "boolean"), ("text", "string")]
    assert rows(loaded) == [(None, 1.0, True, "true"), (None, 2.5, False, "1")]


def test_csv_round_trip_is_exact(spark, mixed, tmp_path):
    fine = mixed.withColumn("t", F.expr("t + INTERVAL '0.000007' SECOND"))
    spec = {"format": "csv", "name": str(tmp_path / "exact.csv")}
    sinks.save(fine, spec)
    assert rows(_back(spark, {**spec, "schema": fine.schema}).drop(SOURCE_FILE_COLUMN)) == rows(fine)
    spec = {"format": "json", "name": str(tmp_path / "exact.json")}
    sinks.save(fine, spec)
    assert rows(_back(spark, {**spec, "schema": fine.schema}).drop(SOURCE_FILE_COLUMN)) == rows(fine)


def test_json_layouts(spark, tmp_path):
    expected = [("x", 1, 0.5), ("y", 2, None)]
    contents = {
        "lines": '{"a": 1, "b": "x", "c": 0.5}\n{"a": 2, "b": "y"}\n',
        "records": '[\n {"a": 1, "b": "x", "c": 0.5},\n {"a": 2, "b": "y", "c": null}\n]',
        "columns": '{"a": {"0": 1, "1": 2}, "b": {"0": "x", "1": "y"}, "c": {"0": 0.5, "1": null}}',
    }
    for layout, text in contents.items():
        path = tmp_path / f"{layout}.json"
        path.write_text(text)
        for spec in ({"layout": layout}, {}):
            loaded = files.load(spark, {"format": "json", "file list": [str(path)], **spec})
            assert rows(loaded.select("b", "a", "c")) == expected
            assert dict(loaded.dtypes)["a"] == "bigint"
            assert {r[0] for r in loaded.select(SOURCE_FILE_COLUMN).collect()} == {f"{layout}.json"}
    with pytest.raises(ValueError):
        files.load(spark, {"format": "json", "file list": ["x"], "layout": "other"})


def test_mixed_json_layouts(spark, tmp_path):
    contents = {
        "1": '{"a": 1, "b": "x"}\n{"a": 2, "b": "y"}\n',
        "2": '[{"a": 3, "b": "z"},\n {"a": 4}]',
        "3": '{"a": {"5": 5, "7": 6},\n "b": {"5": "u"}}',
        "4": '{"a": {"5": 7}}',
        "5": '{\n "a": 8,\n "b": "v"\n}\n',
        "6": "",
    }
    for name, text in contents.items():
        (tmp_path / f"{name}.json").write_text(text)
    expected = [(1, "x"), (2, "y"), (3, "z"), (4, None), (5, "u"), (6, None), (7, None), (8, "v")]
    for given in (str(tmp_path), [str(tmp_path / f"{n}.json") for n in contents]):
        for more in ({}, {"schema": "a bigint, b string"}):
            loaded = files.load(spark, {"format": "json", "file list": given, **more})
            assert rows(loaded.select("a", "b")) == expected
            assert loaded.schema["a"].dataType.simpleString() == "bigint"
    loaded = files.load(spark, {"format": "json", "file list": str(tmp_path / "3.json"), "schema": "a int, c double"})
    assert rows(loaded.select("a", "c")) == [(5, None), (6, None)] and dict(loaded.dtypes)["a"] == "int"
    for text in ('{"a": {}}', "[1]\n[2]", '"a"', '{"a": 1,\n "b"'):
        (tmp_path / "6.json").write_text(text)
        with pytest.raises(ValueError, match="6.json"):
            files.load(spark, {"format": "json", "file list": str(tmp_path)})


def test_compressed_json_documents(spark, tmp_path):
    for name, text in (("c", '{"a": {"0": 1, "1": 2}}'), ("r", '[{"a": 1}, {"a": 2}]')):
        path = tmp_path / f"{name}.json.gz"
        path.write_bytes(gzip.compress(text.encode()))
        loaded = files.load(spark, {"format": "json", "file list": str(path)})
        assert rows(loaded.select("a")) == [(1,), (2,)]


def test_column_layout_over_several_files(spark, tmp_path):
    (tmp_path / "1.json").write_text('{"a": {"0": 1, "1": 2}}')
    (tmp_path / "2.json").write_text('{"a": {"0": 3}, "b": {"0": {"k": [1]}}}')
    loaded = files.load(spark, {"format": "json", "file list": [str(tmp_path / "*.json")]})
    assert rows(loaded.select("a", "b")) == [(1, None), (2, None), (3, '{"k":[1]}')]


def test_parquet_with_missing_columns(spark, tmp_path):
    for name, sql in (("one", "SELECT 1 AS a"), ("two", "SELECT 2 AS a, 'x' AS b")):
        spark.sql(sql).write.parquet(str(tmp_path / name))
    loaded = files.load(spark, {"format": "parquet", "file list": [str(tmp_path / n) for n in ("one", "two")]})
    assert rows(loaded.select("a", "b")) == [(1, None), (2, "x")]


def test_parquet_with_differing_types(spark, tmp_path):
    for name, sql in (("one", "SELECT 1 AS a, 1 AS b"), ("two", "SELECT 2.5D AS a, 'x' AS b")):
        spark.sql(sql).write.parquet(str(tmp_path / name))
    loaded = files.load(spark, {"format": "parquet", "file list": [str(tmp_path / n) for n in ("one", "two")]})
    assert rows(loaded.select("a", "b")) == [(1.0, "1"), (2.5, "x")]


# --------------------------------------------------------------------------- workbooks


def test_workbook_round_trip(spark, mixed, tmp_path):
    spec = {"format": "excel", "name": str(tmp_path / "book.xlsx")}
    sinks.save(mixed, spec)
    loaded = _back(spark, spec)
    kinds = dict(loaded.dtypes)
    assert [kinds[c] for c in "nxsbtd"] == ["bigint", "double", "string", "boolean", "timestamp_ntz", "timestamp_ntz"]
    same = loaded.select(*[F.col(c).cast(k).alias(c) for c, k in mixed.dtypes])
    assert rows(same) == rows(mixed)
    assert loaded.where(~F.col(SOURCE_FILE_COLUMN).startswith("part-")).count() == 0


def test_workbook_rolls_over_when_a_sheet_is_full(spark, tmp_path):
    path = str(tmp_path / "rolled.xlsx")
    workbook.write_workbooks(spark.range(25).coalesce(1), path, max_rows=11)
    names = sorted(p.name for p in (tmp_path / "rolled.xlsx").iterdir() if p.suffix == ".xlsx")
    assert names == [f"part-00000-{i:05d}.xlsx" for i in range(3)]
    assert not [p for p in (tmp_path / "rolled.xlsx").iterdir() if p.name.startswith("_temporary")]
    loaded = files.load(spark, {"format": "excel", "file list": [path]})
    assert sorted(r.id for r in loaded.collect()) == list(range(25))
    with pytest.raises(ValueError):
        workbook.write_workbooks(spark.range(1), path, max_rows=1)


def test_failed_workbook_write_publishes_nothing(spark, tmp_path):
    path = str(tmp_path / "failed.xlsx")
    bad = spark.range(10).select(F.when(F.col("id") == 9, F.raise_error(F.lit("broken"))).alias("x"))
    with pytest.raises(Exception, match="broken"):
        sinks.save(bad, {"format": "excel", "name": path})
    assert runtime.completed_output(spark, path) is None
    assert not [p for p in (tmp_path / "failed.xlsx").iterdir() if not p.name.startswith(".")]


SHEET = (
    '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>'
    '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="inlineStr"><is><t>when</t></is></c></row>'
    '<row r="2"><c r="A2" t="s"><v>1</v></c><c r="C2" s="1"><v>45351.5</v></c></row>'
    '<row r="3"><c r="A3" t="str"><v>calc</v></c><c r="B3"><v>7</v></c><c r="C3" t="e"><v>#N/A</v></c></row>'
    "</sheetData></worksheet>"
)


def _foreign_workbook(path):
    """A workbook as other programs write it: shared strings, a custom date format, two sheets."""
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    link = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    with zipfile.ZipFile(path, "w") as book:
        book.writestr(
            "xl/workbook.xml",
            f'<workbook {main} {link}><sheets><sheet name="One" sheetId="1" r:id="rId2"/>'
            f'<sheet name="Two" sheetId="2" r:id="rId1"/></sheets></workbook>',
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            '<Relationships><Relationship Id="rId1" Target="worksheets/b.xml"/>'
            '<Relationship Id="rId2" Target="/xl/worksheets/a.xml"/></Relationships>',
        )
        book.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>name</t></si><si><r><t>ri</t></r><r><t>ch</t></r></si></sst>")
        book.writestr(
            "xl/styles.xml",
            f'<styleSheet {main}><numFmts><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd"/></numFmts>'
            '<cellXfs><xf numFmtId="0"/><xf numFmtId="164"/></cellXfs></styleSheet>',
        )
        book.writestr("xl/worksheets/a.xml", SHEET)
        book.writestr("xl/worksheets/b.xml", SHEET.replace("calc", "second sheet"))


def test_foreign_workbook(spark, tmp_path):
    _foreign_workbook(tmp_path / "foreign.xlsx")
    loaded = files.load(spark, {"format": "excel", "file list": [str(tmp_path / "foreign.xlsx")]})
    assert loaded.columns == ["name", "Unnamed: 1", "when", SOURCE_FILE_COLUMN]
    assert rows(loaded) == [
        ("calc", 7, None, "foreign.xlsx"), ("rich", None, datetime(2024, 2, 29, 12), "foreign.xlsx"),
    ]
    for listed in (["Two"], [1]):
        spec = {"format": "excel", "file list": [str(tmp_path)], "worksheet list": listed}
        assert "second sheet" in {r.name for r in files.load(spark, spec).collect()}
    with pytest.raises(Exception, match="no sheet named"):
        files.load(spark, {"format": "excel", "file list": [str(tmp_path)], "worksheet list": ["Three"]}).collect()


# --------------------------------------------------------------------------- specifications


def test_specifications(spark, mixed, tmp_path):
    for spec in ({}, {"format": "html"}, {"format": "parquet", "compression": "xz"}):
        with pytest.raises(ValueError):
            sinks.save(mixed, {"name": str(tmp_path / "x"), **spec})
    with pytest.raises(ValueError, match="brotli"):
        sinks.save(mixed, {"name": str(tmp_path / "x"), "format": "parquet", "compression": "brotli"})
    with pytest.raises(ValueError):
        files.load(spark, {"format": "csv"})
    assert formats.with_defaults({"format": "Parquet", "name": "a"}) == {
        "format": "parquet", "name": "a", "field delimiter": ",", "compression": "snappy", "worksheet": 0,
    }
    assert formats.codec({"format": "pickle", "name": "a.xz"}) == "xz"
    assert formats.codec({"format": "json", "compression": "none"}) == "none"
    assert formats.field_delimiter({"field-delimiter": ";"}) == ";"


@pytest.mark.parametrize("chosen", ["parquet", "pickle", "excel"])
def test_modes(spark, chosen, tmp_path):
    spec = {"format": chosen, "name": str(tmp_path / "out")}
    sinks.save(spark.range(3), spec, "error")
    with pytest.raises(Exception):
        sinks.save(spark.range(5), spec, "error")
    sinks.save(spark.range(5), spec, "ignore")
    assert _back(spark, spec).count() == 3
    sinks.save(spark.range(5), spec)
    assert _back(spark, spec).count() == 5
    with pytest.raises(ValueError):
        sinks.save(spark.range(5), spec, "append")


def test_fan_out_reads_the_source_once_and_survives_a_bad_target(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    source = spark.range(10).mapInArrow(counted, "id long")
    targets = [
        {"format": "csv", "name": str(tmp_path / "a.csv")},
        {"format": "parquet", "name": str(tmp_path / "b"), "compression": "brotli"},
        {"format": "json", "name": str(tmp_path / "c.json")},
    ]
    outcome = sinks.save_all(source, targets)
    assert seen.value == 10
    assert [w.error is None for w in outcome] == [True, False, True]
    assert _back(spark, targets[2]).count() == 10


def test_nothing_is_written_for_no_rows(spark, tmp_path):
    assert sinks.save_all(spark.range(0), {"format": "csv", "name": str(tmp_path / "none.csv")}) == []
    assert not (tmp_path / "none.csv").exists()


# --------------------------------------------------------------------------- file tables


def test_listing_and_statistics(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"one\r\ntwo")
    (tmp_path / "b.txt").write_bytes(b"x" * 5000)
    (tmp_path / "c.log").write_bytes(b"")
    assert files.list_files(spark, str(tmp_path), "*.txt").count() == 2
    assert files.list_files(spark, str(tmp_path)).where("length = 0").count() == 1
    assert files.build_file_list(spark, str(tmp_path / "*.none")) == []
    assert files.build_file_list(spark, str(tmp_path / "nowhere" / "*.txt")) == []
    assert files.build_file_list(spark, str(tmp_path / "a.txt"))[0].endswith("/a.txt")
    for limit in (0, 100, 10_000):
        table = files.file_statistics(spark, str(tmp_path), checksum=True, whole_file_limit=limit)
        found = {r["file name"]: r for r in table.collect()}
        for name in ("a.txt", "b.txt", "c.log"):
            content = (tmp_path / name).read_bytes()
            assert found[name]["size [bytes]"] == len(content)
            assert found[name]["MD5 Checksum"] == hashlib.md5(content).hexdigest()
            assert found[name]["SHA512 Checksum"] == hashlib.sha512(content).hexdigest()
    report = files.stale_file_report(spark, str(tmp_path), "CalculatedDate_CYCMCDCH_-48", datetime(2999, 1, 1), "*.txt")
    assert {r.verdict for r in report.collect()} == {"older"}


def test_documents(spark, tmp_path):
    (tmp_path / "q.sql").write_text("SELECT\n  %s\n")
    (tmp_path / "d.json").write_text(json.dumps({"a": [1, "x"]}))
    assert files.read_text_document(spark, str(tmp_path / "q.sql")).first()[0] == "SELECT\n  %s\n"
    value = files.read_json_document(spark, str(tmp_path / "d.json"))
    assert value.select(F.variant_get("document", "$.a[1]", "string")).first()[0] == "x"


def test_scratch_is_below_the_configured_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert runtime.scratch_path(spark, "x").startswith(configured)
    assert moment_literal(date(2024, 1, 1)) is not None


def test_globs(spark, tmp_path):
    for name in ("a1.csv", "b2.csv", "c3.txt"):
        (tmp_path / name).write_text("")
        (tmp_path / f"full-{name}").write_text("x")
    for pattern, count in (("*.csv", 4), ("{a,b}?.csv", 2), ("*[13].*", 4), ("*", 6), ("a.csv", 0)):
        assert files.list_files(spark, str(tmp_path), pattern).count() == count


def test_csv_schema_goes_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    (tmp_path / "b.csv").write_text("b,extra,a\n20,x,10\n")
    (tmp_path / "c.csv").write_text("a\n5\n")
    spec = {"format": "csv", "file list": [str(tmp_path)], "schema": "a int, b int"}
    assert {(r.a, r.b) for r in files.load(spark, spec).collect()} == {(1, 2), (10, 20), (5, None)}


def test_csv_integers_beyond_64_bits_stay_exact(spark, tmp_path):
    (tmp_path / "w.csv").write_text("id,long\n12345678901234567891," + "9" * 50 + "\n12345678901234567892,1\n")
    frame = files.load(spark, {"format": "csv", "file list": [str(tmp_path / "w.csv")]})
    assert dict(frame.dtypes)["id"] == "decimal(38,0)" and dict(frame.dtypes)["long"] == "string"
    assert {str(r.id) for r in frame.collect()} == {"12345678901234567891", "12345678901234567892"}


def test_missing_folder_has_no_files(spark, tmp_path):
    listed = files.list_files(spark, str(tmp_path / "absent"))
    assert listed.columns == ["path", "modificationTime", "length"] and listed.count() == 0


def test_scratch_of_other_applications_stays(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(runtime, "scratch_root", lambda spark: str(tmp_path))
    own = tmp_path / "quarryline" / spark.sparkContext.applicationId / "table"
    assert str(own.parent) == runtime.scratch_path(spark, "x").rsplit("/", 1)[0]
    other = tmp_path / "quarryline" / "application-other" / "table"
    for folder in (own, other):
        folder.mkdir(parents=True)
    runtime.clear_scratch(spark)
    assert not own.exists() and other.exists()


def test_one_line_json_does_not_depend_on_its_neighbours(spark, tmp_path):
    """Objects below numbers on one line: refused, unless other files or a layout say what they are."""
    record = '{"a": {"1": 5}}'
    (tmp_path / "one.json").write_text(record)
    one = {"format": "json", "file list": [str(tmp_path / "one.json")]}
    with pytest.raises(ValueError, match="one.json"):
        files.load(spark, one)
    assert rows(files.load(spark, {**one, "layout": "columns"}).select("a")) == [(5,)]
    assert files.load(spark, {**one, "layout": "lines"}).select("a.1").first()[0] == 5
    (tmp_path / "two.json").write_text(record + "\n" + record.replace("5", "7"))
    both = files.load(spark, {"format": "json", "file list": [str(tmp_path)]})
    assert sorted(r.a["1"] for r in both.collect()) == [5, 5, 7]
    (tmp_path / "two.json").write_text('{"a": {"4": 6,\n "9": 8}}')
    both = files.load(spark, {"format": "json", "file list": [str(tmp_path)]})
    assert rows(both.select("a")) == [(5,), (6,), (8,)]
    (tmp_path / "two.json").write_text('[{"a": 1}]')
    with pytest.raises(ValueError, match="one.json"):
        files.load(spark, {"format": "json", "file list": [str(tmp_path)]})


def test_one_line_records_are_not_written_by_one_task(spark, tmp_path, monkeypatch):
    """Lines go to a file for every task that reads the table, records that stand alone to one of their own."""
    from quarryline.workload import file_queries

    written = []
    real = file_queries.scratch_path
    monkeypatch.setattr(file_queries, "scratch_path", lambda *given: written.append(real(*given)) or written[-1])
    key = F.when(F.col("id") % 1000 != 7, F.col("id")).alias("o_orderkey")
    orders = spark.range(0, 300_000, 1, 4).select(key, (F.col("id") % 91).alias("o_custkey"), F.sha2(F.col("id").cast("string"), 256).alias("o_orderpriority"))
    orders.write.parquet(str(tmp_path / "big" / "orders.parquet"))
    # Four files of two lines each: brought together, and clear beside the single records.
    few = spark.createDataFrame([(k, k) for k in (1, 2, 3, 4, 4, None, None, 5)], "o_orderkey bigint, o_custkey bigint")
    few.repartition(4).write.parquet(str(tmp_path / "few" / "orders.parquet"))
    for name, several in (("big", True), ("few", False)):
        loaded = file_queries.json_one_line_record(spark, str(tmp_path / name))
        given = spark.read.parquet(str(tmp_path / name / "orders.parquet")).select("o_orderkey", "o_custkey")
        assert loaded.dtypes == given.dtypes
        both = [frame.agg(F.count("*"), F.sum(F.hash("o_orderkey", "o_custkey").cast("long")), F.sum("o_orderkey")).first() for frame in (loaded, given)]
        assert both[0] == both[1]
        lines = spark.read.text(written[-1]).groupBy("part", F.input_file_name().alias("file")).count().collect()
        assert sorted(r["count"] for r in lines if r.part != 0) == [1, 1, 1]
        rest = [r["count"] for r in lines if r.part == 0]
        assert (len(rest) > 1 and max(rest) < 0.6 * sum(rest)) if several else rest == [5]


def test_columns_with_different_rows(spark, tmp_path):
    (tmp_path / "same.json").write_text('{"a": {"7": 1, "3": 2},\n "b": {"7": "x", "3": null}}')
    (tmp_path / "other.json").write_text('{"a": {"0": 3, "1": 4},\n "c": {"1": true}}')
    (tmp_path / "order.json").write_text('{"a": {"0": 5, "1": 6},\n "b": {"1": "v", "0": "u"}}')
    loaded = files.load(spark, {"format": "json", "file list": [str(tmp_path)]})
    assert rows(loaded.select("a", "b", "c")) == [(1, "x", None), (2, None, None), (3, None, None), (4, None, True), (5, "u", None), (6, "v", None)]


def test_csv_keeps_white_space_around_values(spark, tmp_path):
    spec = {"format": "csv", "name": str(tmp_path / "blanks.csv"), "schema": "t string"}
    sinks.save(spark.createDataFrame([(" a ",), ("b\n",), ("\tc",)], "t string"), spec)
    assert {r.t for r in files.load(spark, {**spec, "file list": [spec["name"]]}).collect()} == {" a ", "b\n", "\tc"}


def test_parquet_timestamps_follow_the_session(spark, tmp_path):
    """The physical type of instants is the session's setting; there is no option for it."""
    import pyarrow.parquet as pq

    frame = spark.sql("SELECT TIMESTAMP_LTZ '2020-01-01 00:00:00' AS t")
    held = spark.conf.get("spark.sql.parquet.outputTimestampType")
    for setting, physical in (("INT96", "INT96"), ("TIMESTAMP_MICROS", "INT64")):
        spark.conf.set("spark.sql.parquet.outputTimestampType", setting)
        name = tmp_path / setting
        sinks.save(frame, {"format": "parquet", "name": str(name)})
        part = next(name.glob("part-*.parquet"))
        assert pq.ParquetFile(part).schema.column(0).physical_type == physical
    spark.conf.set("spark.sql.parquet.outputTimestampType", held)


def test_failing_targets_are_raised_when_asked_and_no_copy_stays(spark, tmp_path, monkeypatch):
    staged = []
    real = sinks.scratch_path
    monkeypatch.setattr(sinks, "scratch_path", lambda *given: staged.append(real(*given)) or staged[-1])
    targets = [{"format": "csv", "name": str(tmp_path / "a.csv")}, {"format": "parquet", "name": str(tmp_path / "b"), "compression": "brotli"}]
    with pytest.raises(OSError, match="/b"):
        sinks.save_all(spark.range(3), targets, raise_errors=True)
    assert _back(spark, targets[0]).count() == 3
    assert len(staged) == 1 and not files.build_file_list(spark, staged[0])
