"""Running an extraction plan."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.functions.calendar import render_literals
from quarryline.functions.dates import moment_literal
from quarryline.operators.columns import add_columns
from quarryline.plans.freshness import extraction_required
from quarryline.plans.plan import Session, read_plan
from quarryline.plans.template import fill_template, render_parameters
from quarryline.sources.files import file_statistics, read_text_document
from quarryline.sources.jdbc import SPARK_TABLES, query_scan, resolve_connection
from quarryline.sources.sinks import Written, output_statistics, save_all

OUTCOME_SCHEMA = (
    "sequence_index int, query_index int, session_index int, status string, output string, message string"
)


@dataclass(frozen=True)
class Outcome:
    """What became of one session: extracted, skipped, empty or failed."""

    sequence_index: int
    query_index: int
    session_index: int
    status: str
    targets: list[Written] = field(default_factory=list)
    message: str | None = None

    def rows(self) -> list[tuple]:
        place = (self.sequence_index, self.query_index, self.session_index)
        if not self.targets:
            return [(*place, self.status, None, self.message)]
        return [
            (*place, "failed" if t.error else self.status, t.name, t.error or self.message)
            for t in self.targets
        ]


def _load_json(spark: SparkSession, given: str | Mapping | None, top: str) -> Mapping:
    if given is None or isinstance(given, Mapping):
        return (given or {}).get(top, given or {})
    return json.loads(read_text_document(spark, given).first()[0])[top]


def _run_session(
    spark: SparkSession, work: Session, systems: Mapping, credentials: Mapping, as_of: datetime, base: str
) -> Outcome:
    place = (work.sequence_index, work.query_index, work.session_index)
    missing = work.missing_keys()
    if missing:
        return Outcome(*place, "failed", message="missing " + ", ".join(missing))
    names = render_literals(spark, [o["name"] for o in work.outputs], as_of, work.week_start)
    targets = [{**o, "name": os.path.join(base, n)} for o, n in zip(work.outputs, names)]
    condition = work.resolve("extract-overwrite-condition")
    paths = [t["name"] for t in targets]
    if not extraction_required(spark, paths, work.behaviour, as_of, condition):
        return Outcome(*place, "skipped")
    template = read_text_document(spark, os.path.join(base, work.query["input-query-file"])).first()[0]
    parameters = []
    if "parameters" in work.session:
        parameters = render_parameters(
            spark, work.session["parameters"], as_of, work.rules, work.week_start
        )
    kind = f"{work.sequence['server-vendor']} {work.sequence['server-type']}"
    connection = None if kind == SPARK_TABLES else resolve_connection(work.sequence, systems, credentials)
    result = query_scan(spark, fill_template(template, parameters), connection, work.resolve("parallel-scan"))
    result = add_columns(result, work.resolve("additional-columns", []), as_of)
    # A database is asked once, whatever the number of outputs.
    written = save_all(result, targets, stage=True if connection else None)
    if not written:
        return Outcome(*place, "empty")
    return Outcome(*place, "extracted", written)


def _audit_rows(spark: SparkSession, outcomes: list[Outcome], configuration: list[str], checksum: bool) -> DataFrame:
    """Statistics of the configuration files and of the part files of everything that was written."""
    facts = file_statistics(spark, configuration, checksum).select(
        F.lit("configuration").alias("meaning"), F.col("path").alias("output"), "*"
    )
    written = [t.name for o in outcomes for t in o.targets if t.error is None]
    if written:
        outputs = output_statistics(spark, written, checksum)
        facts = facts.unionByName(outputs.withColumn("meaning", F.lit("output")))
    return facts


def run_plan(
    spark: SparkSession,
    plan: str,
    systems: str | Mapping | None = None,
    credentials: str | Mapping | None = None,
    as_of: datetime | None = None,
    base: str = "",
    audit: str | None = None,
    checksum: bool = False,
    parallel_sessions: int = 1,
) -> DataFrame:
    """Run every session of a plan file and return one row per session and output.

    ``systems`` and ``credentials`` are JSON files or mappings; relative names in the plan are
    below ``base``. All sessions see the same ``as_of`` clock. A session that fails is reported
    and the others go on. With ``audit``, the statistics of the configuration files and of the
    written part files are appended to a parquet table there. ``parallel_sessions`` lets independent sessions share the cluster.
    """
    as_of = as_of or spark.sql("SELECT CAST(current_timestamp() AS TIMESTAMP_NTZ)").first()[0]
    known_systems = _load_json(spark, systems, "Systems")
    known_credentials = _load_json(spark, credentials, "Credentials")

    def attempt(work: Session) -> Outcome:
        try:
            return _run_session(spark, work, known_systems, known_credentials, as_of, base)
        except Exception as error:
            place = (work.sequence_index, work.query_index, work.session_index)
            return Outcome(*place, "failed", message=f"{type(error).__name__}: {error}")

    with ThreadPoolExecutor(max_workers=parallel_sessions) as pool:
        outcomes = list(pool.map(attempt, read_plan(spark, plan)))
    if audit:
        facts = _audit_rows(spark, outcomes, [f for f in (plan, systems, credentials) if isinstance(f, str)], checksum)
        facts.withColumn("as_of", moment_literal(as_of)).write.mode("append").parquet(audit)
    return spark.createDataFrame([row for o in outcomes for row in o.rows()], OUTCOME_SCHEMA)
