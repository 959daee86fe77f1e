"""Deciding whether outputs have to be extracted again."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import SparkSession

from quarryline.functions.calendar import barrier_literal
from quarryline.plans.plan import BEHAVIOURS, OVERWRITE
from quarryline.runtime import completed_output

VERDICTS = ("newer", "same", "older", "unknown")


def file_verdict(spark: SparkSession, path: str, which: str, reference) -> str:
    """``newer``, ``same`` or ``older`` for a finished output; ``unknown`` for an unknown date."""
    if which.replace("_", " ") != "last modified":
        return "unknown"
    entry = completed_output(spark, path)
    if entry is None:
        raise FileNotFoundError(path)
    if entry.modified == reference:
        return "same"
    return "newer" if entry.modified > reference else "older"


def output_required(
    spark: SparkSession, path: str, behaviour: str, as_of, condition: Mapping | None = None
) -> bool:
    """Whether one output asks for an extraction.

    Skip: only when it does not exist. Overwrite: always, or with a condition only when the
    existing output compares as the rule says (``older`` unless given) with the calculated date.
    """
    if behaviour not in BEHAVIOURS:
        raise ValueError(f"behaviour must be one of {BEHAVIOURS}, not {behaviour!r}")
    existing = completed_output(spark, path)
    if existing is None:
        return True
    if behaviour != OVERWRITE:
        return False
    if condition is None:
        return True
    limit = barrier_literal(spark, condition["reference-expression"], as_of)
    verdict = file_verdict(spark, path, condition.get("file-datetime", "last modified"), limit)
    if verdict == "unknown":
        raise ValueError(f"files have no {condition['file-datetime']!r} date here, only a last modified one")
    return verdict == condition.get("rule", "older")


def extraction_required(
    spark: SparkSession, paths: Iterable[str], behaviour: str, as_of, condition: Mapping | None = None
) -> bool:
    """An extraction runs only when every one of its outputs asks for it."""
    return all(output_required(spark, path, behaviour, as_of, condition) for path in paths)
