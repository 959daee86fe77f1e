"""Required-key and referential checks."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.functions.dates import quoted
from quarryline.operators.skew import MAX_GROUP_ROWS, split_hot_groups
from quarryline.runtime import broadcast_is_certain


def missing_keys(properties: Column | str, required: list[str]) -> Column:
    """The required keys a map column lacks, in the order they are required."""
    properties = F.col(properties) if isinstance(properties, str) else properties
    wanted = F.array(*[F.lit(k) for k in required])
    return F.when(properties.isNull(), wanted).otherwise(
        F.filter(wanted, lambda key: ~F.map_contains_key(properties, key))
    )


def json_keys(text: Column | str) -> Column:
    """A JSON object as a map of key to text, for key checks."""
    return F.from_json(text, "map<string,string>")


def missing_key_violations(
    df: DataFrame, properties: Column | str, required: list[str], name: str = "missing_key"
) -> DataFrame:
    """One row per missing key; complete rows give none."""
    return df.select("*", F.explode(missing_keys(properties, required)).alias(name))


def complete_rows(df: DataFrame, properties: Column | str, required: list[str]) -> DataFrame:
    return df.where(F.size(missing_keys(properties, required)) == 0)


def _keep_by_keys(df: DataFrame, catalogue: DataFrame, keys: list[str], how: str, hot_rows: int) -> DataFrame:
    """Semi or anti join on composite keys that no single key can slow down.

    Rows with an incomplete key never match and take no part. The catalogue is reduced to
    distinct keys first; when Spark's own limit lets it be broadcast, no row of the table moves.
    Otherwise keys with more than ``hot_rows`` rows are found by a pre-aggregated count. There are
    at most ``rows / hot_rows`` of them, so their part of the join can be a broadcast, and all
    other rows go through an ordinary join.
    """
    columns = [quoted(k) for k in keys]
    complete = reduce(and_, [quoted(k).isNotNull() for k in keys])
    wanted = catalogue.select(*columns).where(complete).distinct()
    rows = df.where(complete)
    split = None if broadcast_is_certain(wanted) else split_hot_groups(rows, keys, hot_rows)
    if split is None:
        kept = rows.join(wanted, keys, how)
    else:
        known_hot = split.keys.select(*[F.col(f"__hot{i}").alias(k) for i, k in enumerate(keys)])
        known_hot = known_hot.join(wanted, keys, "left_semi")
        kept = split.hot.join(F.broadcast(known_hot), keys, how).unionByName(split.rest.join(wanted, keys, how))
    if how == "left_anti":
        kept = kept.unionByName(df.where(~complete))
    return kept.select(*[quoted(c) for c in df.columns])


def resolvable(
    df: DataFrame, catalogue: DataFrame, keys: list[str], hot_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Rows whose composite key exists in the catalogue."""
    return _keep_by_keys(df, catalogue, keys, "left_semi", hot_rows)


def unresolvable(
    df: DataFrame, catalogue: DataFrame, keys: list[str], hot_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Rows whose composite key the catalogue does not know; incomplete keys are unknown."""
    return _keep_by_keys(df, catalogue, keys, "left_anti", hot_rows)


def non_empty_list(items: Column | str) -> Column:
    """True for an array with at least one element; null counts as none."""
    items = F.col(items) if isinstance(items, str) else items
    return F.coalesce(F.size(items) > 0, F.lit(False))
