"""The plan document: sequences of queries of sessions, and how sessions inherit properties."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.operators.columns import FROM_GRAND_PARENT, FROM_PARENT
from quarryline.operators.validation import json_keys, missing_keys
from quarryline.plans.template import DEFAULT_RULES
from quarryline.sources.files import read_text_document

# Keys each level must have.
SEQUENCE_KEYS = ["server-vendor", "server-type", "server-group", "server-layer", "account-label", "queries"]
QUERY_KEYS = ["input-query-file", "sessions"]
SESSION_KEYS = ["extract-behaviour", "output-file"]

# What to do about an output that exists.
SKIP = "skip-if-output-file-exists"
OVERWRITE = "overwrite-if-output-file-exists"
BEHAVIOURS = (SKIP, OVERWRITE)


def _elements(text: Column) -> Column:
    """The elements of a JSON list as texts; null for anything that is not a list."""
    return F.from_json(text, "array<string>")


def is_non_empty_list(document: Column | str) -> Column:
    """True for a JSON text that is a list with at least one element."""
    document = F.col(document) if isinstance(document, str) else document
    return F.coalesce(F.size(_elements(document)) > 0, F.lit(False))


def flatten_plan(df: DataFrame, document: str = "document") -> DataFrame:
    """One row per session with its indexes and its session, query and sequence as JSON texts.

    Works on any number of documents; other columns are kept. Texts keep the order of keys, which
    parameters depend on. Levels without children leave one row with empty lower levels.
    """

    def exploded(text: Column, name: str) -> Column:
        return F.posexplode_outer(_elements(text)).alias(f"{name}_index", name)

    kept = [c for c in df.columns if c != document]
    sequences = df.select(*kept, exploded(F.col(document), "sequence"))
    queries = sequences.select("*", exploded(F.get_json_object("sequence", "$.queries"), "query"))
    return queries.select("*", exploded(F.get_json_object("query", "$.sessions"), "session"))


def plan_violations(df: DataFrame, document: str = "document") -> DataFrame:
    """One row per mandatory key that a level of a plan document lacks, for any number of documents.

    A level is judged once, with its first child.
    """
    first_query, first_session = (F.coalesce(F.col(c), F.lit(0)) == 0 for c in ("query_index", "session_index"))
    judged = {
        "sequence": (first_query & first_session, SEQUENCE_KEYS),
        "query": (first_session & F.col("query").isNotNull(), QUERY_KEYS),
        "session": (F.col("session").isNotNull(), SESSION_KEYS),
    }

    def violation(level: str) -> Callable[[Column], Column]:
        return lambda key: F.struct(F.lit(level).alias("level"), key.alias("missing_key"))

    found = [
        F.when(condition, F.transform(missing_keys(json_keys(level), keys), violation(level))).otherwise(F.array())
        for level, (condition, keys) in judged.items()
    ]
    flat = flatten_plan(df, document)
    return flat.select("*", F.inline(F.concat(*found))).drop("sequence", "query", "session")


@dataclass(frozen=True)
class Session:
    """One unit of work with its parents."""

    sequence_index: int
    query_index: int
    session_index: int
    sequence: Mapping
    query: Mapping
    session: Mapping

    def resolve(self, key: str, default=None):
        """A session property, taken from the query or the sequence when it says so."""
        value = self.session.get(key, default)
        if value == FROM_PARENT:
            return self._required(self.query, key, "query")
        if value == FROM_GRAND_PARENT:
            return self._required(self.sequence, key, "sequence")
        return value

    @staticmethod
    def _required(level: Mapping, key: str, name: str):
        if key not in level:
            raise ValueError(f'"{key}" is inherited from the {name}, which does not have it')
        return level[key]

    @property
    def week_start(self) -> int:
        return self.resolve("start-iso-weekday", 1)

    @property
    def rules(self) -> Mapping:
        return self.resolve("parameters-handling-rules", DEFAULT_RULES)

    @property
    def behaviour(self) -> str:
        chosen = self.session.get("extract-behaviour")
        return chosen if chosen in BEHAVIOURS else SKIP

    @property
    def outputs(self) -> list[Mapping]:
        given = self.session["output-file"]
        if isinstance(given, Mapping):
            return [given]
        if isinstance(given, list) and given and all(isinstance(o, Mapping) for o in given):
            return given
        raise ValueError('"output-file" must be an object or a non-empty list of objects')

    def missing_keys(self) -> list[str]:
        """Mandatory keys that are absent, as ``level: key``."""
        levels = (
            ("sequence", self.sequence, SEQUENCE_KEYS),
            ("query", self.query, QUERY_KEYS),
            ("session", self.session, SESSION_KEYS),
        )
        return [f"{name}: {key}" for name, level, keys in levels for key in keys if key not in level]


def read_plan(spark: SparkSession, path: str) -> list[Session]:
    """The sessions of a plan file, in order. A plan is configuration, so it fits the driver."""
    documents = read_text_document(spark, path).select(F.col("value").alias("document"))
    rows = flatten_plan(documents.where(is_non_empty_list("document"))).collect()
    if not rows:
        raise ValueError(f"{path} must hold a list with at least one extraction sequence")
    sessions = []
    for row in sorted(rows, key=lambda r: (r.sequence_index, r.query_index or 0, r.session_index or 0)):
        levels = [json.loads(text or "{}") for text in (row.sequence, row.query, row.session)]
        childless = levels[0].get("queries") == [] or levels[1].get("sessions") == []
        if not childless:
            sessions.append(Session(row.sequence_index, row.query_index or 0, row.session_index or 0, *levels))
    return sessions
