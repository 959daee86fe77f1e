"""Query templates with ``%s`` placeholders."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from quarryline.functions.calendar import render_literals
from quarryline.sources.jdbc import Connection, query_scan

# How lists and mappings are rendered when a plan gives no rules (numbers).
DEFAULT_RULES = {
    "dict-values-glue": ", ",
    "dict-values-prefix": "IN (",
    "dict-values-suffix": ")",
    "list-values-glue": ", ",
    "list-values-prefix": "",
    "list-values-suffix": "",
}


def _joined(kind: str, values, rules: Mapping) -> str:
    inner = rules[f"{kind}-values-glue"].join(str(v) for v in values)
    return f"{rules[f'{kind}-values-prefix']}{inner}{rules[f'{kind}-values-suffix']}"


def render_parameters(
    spark: SparkSession,
    parameters: Mapping | list,
    as_of,
    rules: Mapping | None = None,
    week_start: int = 1,
    month_end: str = "roll_forward",
) -> list[str]:
    """Parameters of a session as texts, in the order they are given.

    Texts have their calculated dates evaluated, lists and mappings are joined by the rules
    (their elements are taken as they are), other values are printed.
    """
    if isinstance(parameters, Mapping):
        ordered = list(parameters.values())
    elif isinstance(parameters, (list, tuple)):
        ordered = list(parameters)
    else:
        raise ValueError(f"parameters must be a mapping or a list, not {type(parameters).__name__}")
    rules = rules or DEFAULT_RULES
    texts = [p for p in ordered if isinstance(p, str)]
    rendered = iter(render_literals(spark, texts, as_of, week_start, month_end))
    result = []
    for parameter in ordered:
        if isinstance(parameter, str):
            result.append(next(rendered))
        elif isinstance(parameter, Mapping):
            result.append(_joined("dict", parameter.values(), rules))
        elif isinstance(parameter, (list, tuple)):
            result.append(_joined("list", parameter, rules))
        else:
            result.append(str(parameter))
    return result


def placeholder_count(template: str) -> int:
    return template.count("%s")


def fill_template(template: str, parameters: list[str]) -> str:
    """Put the parameters into a template; a differing number of them is an error."""
    expected = placeholder_count(template)
    if expected == 0:
        return template
    if expected != len(parameters):
        raise ValueError(f"the query expects {expected} parameters but {len(parameters)} were provided")
    return template % tuple(parameters)


def template_scan(
    spark: SparkSession,
    template: str,
    parameters: Mapping | list,
    as_of,
    rules: Mapping | None = None,
    connection: Connection | None = None,
    split: Mapping | None = None,
) -> DataFrame:
    """Render a template and read its result."""
    query = fill_template(template, render_parameters(spark, parameters, as_of, rules))
    return query_scan(spark, query, connection, split)
