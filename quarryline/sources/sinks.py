"""Writing tables to files, once or to several targets."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.runtime import java_class_exists, path_exists, qualified, remove_output, scratch_path
from quarryline.sources.files import file_statistics
from quarryline.sources.formats import codec, field_delimiter, file_format
from quarryline.sources.pickled import write_pickled
from quarryline.sources.workbook import MAX_SHEET_ROWS, write_workbooks

# Fixed value: the class Parquet loads to write brotli; it comes in a jar of its own.
BROTLI_CLASS = "org.apache.hadoop.io.compress.BrotliCodec"

# How timestamps are written as text, to the microsecond.
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

MODES = ("error", "ignore", "overwrite")


def save(df: DataFrame, spec: Mapping, mode: str = "overwrite") -> None:
    """Write one table as a folder of part files.

    ``spec``: ``format`` (csv, excel, json, parquet, pickle), ``name`` (the folder) and optionally
    ``compression``, ``field delimiter`` and ``max sheet rows``. Modes are error, ignore, overwrite.
    """
    chosen, packed = file_format(spec), codec(spec)
    if packed == "brotli" and not java_class_exists(df.sparkSession, BROTLI_CLASS):
        raise ValueError("this Spark installation has no brotli codec; choose zstd instead")
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    path = qualified(df.sparkSession, spec["name"])
    if chosen in ("csv", "json", "parquet"):
        writer = df.write.mode(mode).options(
            compression=packed, timestampFormat=TIMESTAMP_TEXT, timestampNTZFormat=TIMESTAMP_TEXT
        )
        if chosen == "csv":
            kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
            writer.options(header=True, sep=field_delimiter(spec), escape='"', **kept).csv(path)
        elif chosen == "json":
            writer.option("ignoreNullFields", False).json(path)
        else:
            writer.parquet(path)
        return
    if path_exists(df.sparkSession, path):
        if mode == "ignore":
            return
        if mode == "error":
            raise FileExistsError(path)
        remove_output(df.sparkSession, path)
    if chosen == "excel":
        write_workbooks(df, path, int(spec.get("max sheet rows", MAX_SHEET_ROWS)))
    else:
        write_pickled(df, path, packed)


@contextmanager
def staged(df: DataFrame, label: str = "staged") -> Iterator[DataFrame]:
    """The same rows read back from a table in the shared scratch folder, which is removed afterwards.

    Several sinks can then read them without asking the source again, also after lost executors.
    """
    path = scratch_path(df.sparkSession, label)
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        remove_output(df.sparkSession, path)


@dataclass(frozen=True)
class Written:
    """What became of one target: no error means it was written."""

    name: str
    error: str | None = None


def save_all(
    df: DataFrame,
    specs: Mapping | list[Mapping],
    mode: str = "overwrite",
    stage: bool | None = None,
    raise_errors: bool = False,
) -> list[Written]:
    """Write one result to every target; nothing is written when it has no rows.

    The result is staged once when there are several targets, or when asked for because the query
    must not run twice; otherwise it is written straight from the query after a one-row probe. A
    target that fails does not keep the others from being written; it is reported, or raised after the others with
    ``raise_errors``.
    """
    specs = [specs] if isinstance(specs, Mapping) else list(specs)
    once = len(specs) > 1 if stage is None else stage
    with staged(df) if once else nullcontext(df) as source:
        if source.isEmpty():
            return []
        outcome = []
        for spec in specs:
            try:
                save(source, spec, mode)
                outcome.append(Written(spec["name"]))
            except Exception as error:
                outcome.append(Written(spec["name"], f"{type(error).__name__}: {error}"))
    failed = [target for target in outcome if target.error is not None]
    if failed and raise_errors:
        raise OSError("; ".join(f"{target.name}: {target.error}" for target in failed))
    return outcome


def output_statistics(spark: SparkSession, names: list[str], checksum: bool = False) -> DataFrame:
    """Statistics of the part files of several outputs, with the output they belong to."""
    parts = [
        file_statistics(spark, qualified(spark, name), checksum, pattern="part-*").select(
            F.lit(name).alias("output"), "*"
        )
        for name in names
    ]
    return reduce(DataFrame.unionByName, parts)
