"""Templates and plans."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.functions.calendar import render_literals
from quarryline.plans.freshness import extraction_required
from quarryline.plans.plan import OVERWRITE, SKIP, flatten_plan, is_non_empty_list, plan_violations
from quarryline.plans.runner import run_plan
from quarryline.plans.template import template_scan
from quarryline.runtime import scratch_path
from quarryline.sources import files, sinks
from quarryline.workload.registry import query, table

TEMPLATE = "SELECT %s FROM %s WHERE %s %s"

QUOTED_RULES = {
    "dict-values-glue": "', '",
    "dict-values-prefix": "IN ('",
    "dict-values-suffix": "')",
    "list-values-glue": ", ",
    "list-values-prefix": "",
    "list-values-suffix": "",
}

AS_OF = datetime(1998, 3, 15, 9, 30)


def _view(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A view over a table under a name of its own, for use in SQL text."""
    view = f"quarryline_{name}"
    table(spark, sf_dir, name).createOrReplaceTempView(view)
    return view


@query(
    "F4_template_in_list",
    "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_returnflag IN ('A', 'R')",
)
def template_over_lineitem(spark, sf_dir):
    parameters = {
        "Select Fields": ["l_orderkey", "l_quantity"],
        "From": _view(spark, sf_dir, "lineitem"),
        "Filter Field": "l_returnflag",
        "Filter Values": {"Accepted": "A", "Returned": "R"},
    }
    return template_scan(spark, TEMPLATE, parameters, AS_OF, QUOTED_RULES)


@query(
    "T7_template_fill",
    "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderpriority LIKE '1%' GROUP BY o_orderstatus",
)
def template_fill(spark, sf_dir):
    template = "SELECT %s, count(*) AS n FROM %s WHERE o_orderpriority LIKE '1%%' GROUP BY o_orderstatus"
    return template_scan(spark, template, ["o_orderstatus", _view(spark, sf_dir, "orders")], AS_OF)


@query(
    "T6_parameters_with_dates",
    """SELECT o_orderkey, o_orderdate FROM orders WHERE strftime(o_orderdate, '%Y%m') IN ('199802', '199803')
        AND o_custkey >= 10""",
)
def parameters_with_dates(spark, sf_dir):
    template = "SELECT %s FROM %s WHERE date_format(o_orderdate, 'yyyyMM') IN ('%s', '%s') AND o_custkey >= %s"
    parameters = [
        ["o_orderkey", "o_orderdate"], _view(spark, sf_dir, "orders"),
        "CalculatedDate_CYCM_-1", "CalculatedDate_CurrentYearCurrentMonth", 10,
    ]
    return template_scan(spark, template, parameters, AS_OF)


@query(
    "S3_query_scan",
    """SELECT n_name, count(*) AS customers, max(c_acctbal) AS best FROM customer JOIN nation
        ON c_nationkey = n_nationkey GROUP BY n_name""",
)
def sql_pass_through(spark, sf_dir):
    customer, nation = _view(spark, sf_dir, "customer"), _view(spark, sf_dir, "nation")
    template = "SELECT n_name, count(*) AS customers, max(c_acctbal) AS best FROM %s JOIN %s ON %s GROUP BY n_name"
    return template_scan(spark, template, [customer, nation, "c_nationkey = n_nationkey"], AS_OF)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plan-like document per customer: one sequence, two queries, two sessions and one."""

    def session(name: str):
        return F.struct(F.concat(F.lit(f"{name}-"), "c_name").alias("output-file"))

    def one_query(name: str, *sessions):
        return F.struct(F.lit(name).alias("input-query-file"), F.array(*sessions).alias("sessions"))

    sequence = F.struct(
        F.col("c_mktsegment").alias("server-group"),
        F.array(one_query("first.sql", session("a"), session("b")), one_query("second.sql", session("c"))).alias("queries"),
    )
    text = F.to_json(F.array(sequence))
    return table(spark, sf_dir, "customer").select("c_custkey", text.alias("document"))


@query(
    "P1_flatten_plan",
    """SELECT c_custkey, 0 AS sequence_index, q AS query_index, s AS session_index, c_mktsegment AS grp, f AS file,
        n || '-' || c_name AS output FROM customer, (VALUES (0, 0, 'first.sql', 'a'), (0, 1, 'first.sql', 'b'),
        (1, 0, 'second.sql', 'c')) AS t(q, s, f, n)""",
)
def flatten(spark, sf_dir):
    return flatten_plan(_documents(spark, sf_dir)).select(
        "c_custkey", "sequence_index", "query_index", "session_index",
        F.get_json_object("sequence", "$['server-group']").alias("grp"),
        F.get_json_object("query", "$['input-query-file']").alias("file"),
        F.get_json_object("session", "$['output-file']").alias("output"),
    )


@query(
    "F8_plan_violations",
    """SELECT c_custkey, q AS query_index, s AS session_index, level, k AS missing_key FROM customer, (VALUES
        (0, 0, 'sequence', 'server-vendor'), (0, 0, 'sequence', 'server-type'), (0, 0, 'sequence', 'server-layer'),
        (0, 0, 'sequence', 'account-label'), (0, 0, 'session', 'extract-behaviour'),
        (0, 1, 'session', 'extract-behaviour'), (1, 0, 'session', 'extract-behaviour')) AS t(q, s, level, k)""",
)
def violations(spark, sf_dir):
    return plan_violations(_documents(spark, sf_dir)).drop("sequence_index")


@query("F10_plan_is_non_empty_list", "SELECT c_custkey, c_acctbal >= 0 AS ok FROM customer")
def plan_is_list(spark, sf_dir):
    documents = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") >= 0, F.lit('[{"queries": []}]'))
        .when(F.col("c_nationkey") < 10, F.lit("[]"))
        .otherwise(F.lit('{"queries": []}'))
        .alias("text"),
    )
    return documents.select("c_custkey", is_non_empty_list("text").alias("ok"))


# --------------------------------------------------------------------------- freshness of outputs


def _after_second_run(spark, sf_dir, behaviour: str, condition: dict | None = None, as_of=AS_OF) -> DataFrame:
    """Extract the finished orders, then decide about the open ones, and read what is there."""
    target = {"format": "parquet", "name": scratch_path(spark, "fresh")}
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    for status in ("= 'F'", "<> 'F'"):
        if extraction_required(spark, [target["name"]], behaviour, as_of, condition):
            sinks.save_all(orders.where(f"o_orderstatus {status}"), target)
    return files.load(spark, {**target, "file list": [target["name"]]}).select("o_orderkey", "o_orderstatus")


_DONE_SQL = "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'"
_OPEN_SQL = "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'"


@query("K9_skip_if_exists", _DONE_SQL)
def skip_if_exists(spark, sf_dir):
    return _after_second_run(spark, sf_dir, SKIP)


@query("K10_overwrite_if_exists", _OPEN_SQL)
def overwrite_if_exists(spark, sf_dir):
    return _after_second_run(spark, sf_dir, OVERWRITE)


_AN_HOUR_AGO = {"file-datetime": "last_modified", "reference-expression": "CalculatedDate_CYCMCDCH_-1", "rule": "older"}


@query("K11_overwrite_when_older", _OPEN_SQL)
def overwrite_when_older(spark, sf_dir):
    return _after_second_run(spark, sf_dir, OVERWRITE, _AN_HOUR_AGO, datetime(2999, 1, 1))


@query("K11_keep_when_newer", _DONE_SQL)
def keep_when_newer(spark, sf_dir):
    return _after_second_run(spark, sf_dir, OVERWRITE, _AN_HOUR_AGO, datetime(1999, 1, 1))


@query("K12_every_output_must_ask", f"SELECT 'kept' AS run, * FROM ({_DONE_SQL})")
def every_output_must_ask(spark, sf_dir):
    """One output exists, the other does not: the skip verdict of one decides for both."""
    base = scratch_path(spark, "verdict")
    existing, missing = f"{base}-existing", f"{base}-missing"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    sinks.save_all(orders.where("o_orderstatus = 'F'"), {"format": "parquet", "name": existing})
    if extraction_required(spark, [existing, missing], SKIP, AS_OF):
        sinks.save_all(orders, [{"format": "parquet", "name": n} for n in (existing, missing)])
    return files.load(spark, {"format": "parquet", "file list": [existing]}).select(
        F.lit("kept").alias("run"), "o_orderkey", "o_orderstatus"
    )


@query(
    "K13_output_name_templating",
    """SELECT 'extract-199803-F' AS output, o_orderkey FROM orders WHERE o_orderstatus = 'F' UNION ALL
        SELECT '1998Q1-not-F', o_orderkey FROM orders WHERE o_orderstatus <> 'F'""",
)
def output_name_templating(spark, sf_dir):
    base = scratch_path(spark, "named")
    wanted = {"= 'F'": "extract-CalculatedDate_CYCM-F", "<> 'F'": "CalculatedDate_CYCQ-not-F"}
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    for condition, name in zip(wanted, render_literals(spark, list(wanted.values()), AS_OF)):
        sinks.save(orders.where(f"o_orderstatus {condition}"), {"format": "parquet", "name": f"{base}/{name}"})
    loaded = [
        files.load(spark, {"format": "parquet", "file list": [f"{base}/{name}"]}).select(
            F.lit(name).alias("output"), "o_orderkey"
        )
        for name in ("extract-199803-F", "1998Q1-not-F")
    ]
    return loaded[0].unionByName(loaded[1])


# --------------------------------------------------------------------------- the whole job


def _plan(view: str) -> list[dict]:
    """Two sequences; the second one overrides and inherits properties."""
    fields = ["o_orderkey", "o_orderstatus", "o_totalprice"]

    def session(status: dict, outputs, **more) -> dict:
        parameters = {"Fields": fields, "From": view, "Field": "o_orderstatus", "Values": status}
        return {"extract-behaviour": SKIP, "output-file": outputs, "parameters": parameters, **more}

    place = {
        "server-vendor": "Apache", "server-type": "Spark", "server-group": "Here", "server-layer": "Test",
        "account-label": "Default", "parameters-handling-rules": QUOTED_RULES,
    }
    inherited = {"parameters-handling-rules": "inherit-from-grand-parent"}
    from_query = {"additional-columns": "inherit-from-parent"}
    return [
        {
            **place,
            "queries": [
                {
                    "input-query-file": "template.sql",
                    "additional-columns": [{"name": "Layer", "value": "Test"}],
                    "sessions": [
                        session(
                            {"Done": "F"},
                            [
                                {"format": "parquet", "name": "done-CalculatedDate_CYCM_-1.parquet"},
                                {"format": "csv", "name": "done-CalculatedDate_CYCM_-1.csv", "field delimiter": "|"},
                            ],
                            **inherited, **from_query,
                        ),
                        session(
                            {"Open": "O", "Pending": "P"},
                            {"format": "json", "name": "open-CalculatedDate_CYCW.json"},
                            **inherited,
                            **{"additional-columns": [{"name": "Layer", "value": "Own"}]},
                        ),
                        session({"Nobody": "Z"}, {"format": "csv", "name": "empty.csv"}, **inherited),
                    ],
                }
            ],
        },
        {
            **place,
            "queries": [
                {
                    "input-query-file": "template.sql",
                    "sessions": [
                        session({"Done": "F"}, {"format": "parquet", "name": "done-199802.parquet"}, **inherited),
                        session({"Done": "F"}, "not an output", **inherited),
                    ],
                }
            ],
        },
    ]


def _run(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    base = scratch_path(spark, "plan")
    view = _view(spark, sf_dir, "orders")
    for name, text in (("template.sql", TEMPLATE), ("plan.json", json.dumps(_plan(view)))):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{base}/{name}")
    return base, run_plan(spark, f"{base}/plan.json", as_of=AS_OF, base=base, audit=f"{base}/audit")


@query(
    "J1_run_plan",
    """SELECT 'done.parquet' AS output, o_orderkey, o_totalprice, 'Test' AS layer FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT 'done.csv', o_orderkey, o_totalprice, 'Test' FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT 'open.json', o_orderkey, o_totalprice, 'Own' FROM orders WHERE o_orderstatus IN ('O', 'P')""",
)
def plan_outputs(spark, sf_dir):
    base, _ = _run(spark, sf_dir)
    outputs = {
        "done.parquet": {"format": "parquet", "name": f"{base}/done-199802.parquet"},
        "done.csv": {"format": "csv", "name": f"{base}/done-199802.csv", "field delimiter": "|"},
        "open.json": {"format": "json", "name": f"{base}/open-199811.json"},
    }
    loaded = [
        files.load(spark, {**spec, "file list": [spec["name"]]}).select(
            F.lit(label).alias("output"), "o_orderkey", "o_totalprice", F.col("Layer").alias("layer")
        )
        for label, spec in outputs.items()
    ]
    return loaded[0].unionByName(loaded[1]).unionByName(loaded[2])


@query(
    "J1_plan_outcomes",
    """SELECT * FROM (VALUES (0, 0, 0, 'extracted'), (0, 0, 0, 'extracted'), (0, 0, 1, 'extracted'), (0, 0, 2, 'empty'),
        (1, 0, 0, 'skipped'), (1, 0, 1, 'failed')) AS t(sequence_index, query_index, session_index, status)""",
)
def plan_outcomes(spark, sf_dir):
    _, outcomes = _run(spark, sf_dir)
    return outcomes.select("sequence_index", "query_index", "session_index", "status")
