"""Templates, plan documents, freshness and whole runs."""

import json
import os
from datetime import datetime

import pytest
from conftest import rows

from quarryline.plans import freshness, plan, template
from quarryline.plans.runner import run_plan
from quarryline.sources import files

AS_OF = datetime(2020, 1, 31, 19)


def test_parameters(spark):
    parameters = {
        "fields": ["a", "b"], "table": "t_CalculatedDate_CYCM_-1", "values": {"x": "1", "y": 2}, "number": 5, "none": None,
    }
    assert template.render_parameters(spark, parameters, AS_OF) == ["a, b", "t_201912", "IN (1, 2)", "5", "None"]
    kept = template.render_parameters(spark, [["CalculatedDate_CY"]], AS_OF)
    assert kept == ["CalculatedDate_CY"]
    rules = {**template.DEFAULT_RULES, "list-values-glue": "', '", "list-values-prefix": "('", "list-values-suffix": "')"}
    assert template.render_parameters(spark, [["a", "b"]], AS_OF, rules) == ["('a', 'b')"]
    with pytest.raises(ValueError):
        template.render_parameters(spark, "text", AS_OF)


def test_filling():
    assert template.fill_template("SELECT %s FROM %s", ["a", "b"]) == "SELECT a FROM b"
    assert template.fill_template("LIKE 'x%'", []) == "LIKE 'x%'"
    assert template.fill_template("LIKE 'x%%' AND %s", ["y"]) == "LIKE 'x%' AND y"
    for wrong in ([], ["a", "b"]):
        with pytest.raises(ValueError, match="expects 1"):
            template.fill_template("%s", wrong)


def _write(path, content):
    path.write_text(content if isinstance(content, str) else json.dumps(content))
    return str(path)


def test_plan_documents(spark, tmp_path):
    for bad in ({}, [], {"queries": []}, 5):
        with pytest.raises(ValueError, match="at least one"):
            plan.read_plan(spark, _write(tmp_path / "bad.json", bad))
    good = [
        {"queries": [{"sessions": [{"z": 1, "a": {"y": 1, "b": 2}}, {"s": 2}]}, {"sessions": []}]},
        {"queries": []},
        {"other": 1},
    ]
    sessions = plan.read_plan(spark, _write(tmp_path / "good.json", good))
    assert [(s.sequence_index, s.query_index, s.session_index) for s in sessions] == [(0, 0, 0), (0, 0, 1), (2, 0, 0)]
    assert list(sessions[0].session) == ["z", "a"] and list(sessions[0].session["a"]) == ["y", "b"]
    assert "sequence: queries" in sessions[2].missing_keys()


def test_violations_of_plan_tables(spark):
    full = {k: "x" for k in plan.SEQUENCE_KEYS}
    documents = [
        [{**full, "queries": [{"sessions": [{"output-file": None, "extract-behaviour": "x"}, {}]}]}],
        [{"queries": []}, full],
        "not a list",
    ]
    frame = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(documents)], "i int, document string")
    seen = rows(plan.plan_violations(frame).select("i", "sequence_index", "level", "missing_key"))
    expected = [(0, 0, "query", "input-query-file")]
    expected += [(0, 0, "session", k) for k in plan.SESSION_KEYS]
    expected += [(1, 0, "sequence", k) for k in plan.SEQUENCE_KEYS if k != "queries"]
    assert [s for s in seen if s[0] < 2] == sorted(expected, key=repr)


def _session(session, query=None, sequence=None):
    return plan.Session(0, 0, 0, sequence or {}, query or {}, session)


def test_inheritance():
    levels = ({"start-iso-weekday": 7}, {"start-iso-weekday": 3})
    assert _session({}, *levels).week_start == 1
    assert _session({"start-iso-weekday": 5}, *levels).week_start == 5
    assert _session({"start-iso-weekday": "inherit-from-parent"}, *levels).week_start == 7
    assert _session({"start-iso-weekday": "inherit-from-grand-parent"}, *levels).week_start == 3
    with pytest.raises(ValueError, match="does not have it"):
        _session({"start-iso-weekday": "inherit-from-parent"}).week_start
    assert _session({}).rules == template.DEFAULT_RULES
    assert _session({"extract-behaviour": "nonsense"}).behaviour == plan.SKIP
    assert _session({"output-file": {"name": "x"}}).outputs == [{"name": "x"}]
    for wrong in ("x", [], ["x"]):
        with pytest.raises(ValueError):
            _session({"output-file": wrong}).outputs


def test_freshness(spark, tmp_path):
    target, absent = tmp_path / "out.csv", str(tmp_path / "absent")
    target.write_text("x")
    moment = datetime(2020, 1, 31, 12)
    os.utime(target, times=(moment.timestamp(), moment.timestamp()))

    def asks(expression, rule="older", **more):
        condition = {"reference-expression": f"CalculatedDate_{expression}", "rule": rule, **more}
        return freshness.output_required(spark, str(target), plan.OVERWRITE, AS_OF, condition)

    assert asks("CYCMCDCH_-1") and not asks("CYCMCDCH_-10")
    assert asks("CYCMCDCH_-10", "newer") and not asks("CYCMCDCH_-1", "newer")
    assert asks("CYCMCDCH_-7", "same")
    with pytest.raises(ValueError, match="created"):
        asks("CYCMCDCH_-1", **{"file-datetime": "created"})
    with pytest.raises(ValueError, match="time line"):
        asks("CYCW")
    assert not freshness.output_required(spark, str(target), plan.SKIP, AS_OF)
    assert freshness.output_required(spark, absent, plan.SKIP, AS_OF)
    assert freshness.output_required(spark, str(target), plan.OVERWRITE, AS_OF)
    assert not freshness.extraction_required(spark, [absent, str(target)], plan.SKIP, AS_OF)
    assert freshness.extraction_required(spark, [], plan.SKIP, AS_OF)
    assert freshness.file_verdict(spark, str(target), "accessed", AS_OF) == "unknown"
    with pytest.raises(ValueError):
        freshness.output_required(spark, absent, "sometimes", AS_OF)


def test_an_unfinished_folder_does_not_count(spark, tmp_path):
    folder = tmp_path / "half"
    folder.mkdir()
    (folder / "part-00000").write_text("x")
    assert freshness.output_required(spark, str(folder), plan.SKIP, AS_OF)
    (folder / "_SUCCESS").write_text("")
    assert not freshness.output_required(spark, str(folder), plan.SKIP, AS_OF)


PLACE = {
    "server-vendor": "Apache", "server-type": "Spark", "server-group": "g", "server-layer": "l", "account-label": "a",
}


def _plan_over(view, sessions, **more):
    return [{**PLACE, **more, "queries": [{"input-query-file": "q.sql", "sessions": sessions}]}]


def _parameters(view, condition="id >= 0"):
    return {"fields": ["id", "CAST(id AS STRING) AS text"], "from": view, "where": condition}


@pytest.fixture
def workspace(spark, tmp_path):
    spark.range(20).createOrReplaceTempView("numbers")
    _write(tmp_path / "q.sql", "SELECT %s\nFROM %s\nWHERE %s")
    return tmp_path


def _run(spark, workspace, document, **more):
    path = _write(workspace / "plan.json", document)
    outcome = run_plan(spark, path, as_of=AS_OF, base=str(workspace), **more)
    return [(r.status, (r.output or "").rsplit("/", 1)[-1], r.message) for r in outcome.collect()]


def test_whole_run(spark, workspace):
    outputs = [
        {"format": f, "name": f"all-CalculatedDate_CYCM.{f}"} for f in ("csv", "json", "parquet", "pickle", "excel")
    ]
    stamp = [{"name": "Calculated Timestamp [UTC]", "value": "utcnow"}]
    document = _plan_over(
        "numbers",
        [
            {
                "extract-behaviour": plan.OVERWRITE, "output-file": outputs, "parameters": _parameters("numbers"),
                "additional-columns": "inherit-from-grand-parent",
            },
            {"extract-behaviour": plan.SKIP, "output-file": {"format": "csv", "name": "none.csv"},
             "parameters": _parameters("numbers", "id < 0")},
            {"extract-behaviour": plan.SKIP, "output-file": {"format": "csv", "name": "bad.csv"},
             "parameters": _parameters("no_such_table")},
            {"extract-behaviour": plan.SKIP, "output-file": {"format": "csv", "name": "few.csv"}, "parameters": ["id"]},
            {"output-file": {"format": "csv", "name": "x.csv"}},
            {"extract-behaviour": plan.SKIP, "output-file": {"format": "csv", "name": "all-202001.csv"},
             "parameters": _parameters("numbers", "id < 3")},
        ],
        **{"additional-columns": stamp},
    )
    audit = str(workspace / "audit")
    seen = _run(spark, workspace, document, audit=audit, checksum=True)
    assert [s[:2] for s in seen] == [
        *[("extracted", f"all-202001.{f}") for f in ("csv", "json", "parquet", "pickle", "excel")],
        ("empty", ""), ("failed", ""), ("failed", ""), ("failed", ""), ("skipped", ""),
    ]
    assert "no_such_table" in seen[6][2] and "expects 3" in seen[7][2] and "extract-behaviour" in seen[8][2]
    for output in outputs:
        name = str(workspace / output["name"].replace("CalculatedDate_CYCM", "202001"))
        loaded = files.load(spark, {"format": output["format"], "file list": [name]})
        kept = loaded.selectExpr("CAST(id AS BIGINT)", "CAST(text AS STRING)", "CAST(`Calculated Timestamp [UTC]` AS TIMESTAMP_NTZ)")
        assert rows(kept) == sorted([(i, str(i), AS_OF) for i in range(20)], key=repr)
    audited = spark.read.parquet(audit)
    assert audited.where("meaning = 'output'").select("output").distinct().count() == 5
    assert audited.where("meaning = 'configuration'").count() == 1
    assert audited.where("length(`MD5 Checksum`) <> 32").count() == 0
    again = _run(spark, workspace, document, parallel_sessions=3)
    assert [s[0] for s in again] == [s[0] for s in seen]


def test_conditional_overwrite_in_a_run(spark, workspace):
    def document(hours, condition="id >= 0"):
        rule = {"reference-expression": f"CalculatedDate_CYCMCDCH_{hours}", "rule": "older", "file-datetime": "last_modified"}
        session = {
            "extract-behaviour": plan.OVERWRITE, "extract-overwrite-condition": "inherit-from-grand-parent",
            "output-file": {"format": "parquet", "name": "fresh"}, "parameters": _parameters("numbers", condition),
        }
        return _plan_over("numbers", [session], **{"extract-overwrite-condition": rule})

    assert _run(spark, workspace, document(-1))[0][0] == "extracted"
    assert _run(spark, workspace, document(-1, "id < 5"))[0][0] == "skipped"
    path = _write(workspace / "plan.json", document(-1, "id < 5"))
    later = run_plan(spark, path, as_of=datetime(2999, 1, 1), base=str(workspace)).collect()
    assert later[0].status == "extracted"
    assert files.load(spark, {"format": "parquet", "file list": [str(workspace / "fresh")]}).count() == 5


def test_database_sequences_need_catalogue_and_credentials(spark, workspace):
    session = {"extract-behaviour": plan.SKIP, "output-file": {"format": "csv", "name": "db.csv"},
               "parameters": _parameters("numbers")}
    document = _plan_over("numbers", [session], **{"server-vendor": "Oracle", "server-type": "MySQL"})
    systems = _write(workspace / "systems.json", {"Systems": {"Oracle": {"MySQL": {"Server": {}}}}})
    (status, _, message), = _run(spark, workspace, document, systems=systems, credentials={"Credentials": {}})
    assert status == "failed" and "source catalogue" in message


def test_database_queries_go_to_the_jdbc_source(spark, workspace):
    """The vendor's driver is not installed, so Spark stops before it contacts anything."""
    session = {"extract-behaviour": plan.SKIP, "output-file": {"format": "csv", "name": "db.csv"},
               "parameters": _parameters("numbers"), "parallel-scan": {"column": "id", "lower": 0, "upper": 9, "partitions": 3}}
    place = {**PLACE, "server-vendor": "Oracle", "server-type": "MySQL"}
    document = _plan_over("numbers", [session, {k: v for k, v in session.items() if k != "parallel-scan"}], **place)
    systems = {"Oracle": {"MySQL": {"Server": {"g": {"l": {"ServerName": "db.invalid", "ServerPort": 3306}}}}}}
    account = {"Name": "n", "Username": "u", "Password": "made-up"}
    credentials = {"Oracle": {"MySQL": {"g": {"l": {"a": account}}}}}
    for status, _, message in _run(spark, workspace, document, systems=systems, credentials=credentials):
        assert status == "failed" and "com.mysql.cj.jdbc.Driver" in message and "made-up" not in message
