"""Session-level helpers: shared scratch space and Hadoop file-system access."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from dataclasses import dataclass
from datetime import datetime
from pathlib import Path
from zoneinfo import ZoneInfo

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder of this machine.
    """
    context = spark.sparkContext
    configured = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir", None)
        or context.getCheckpointDir()
    )
    if configured:
        return configured
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the whole cluster")
    fallback = "file://" + tempfile.mkdtemp(prefix="quarryline-")
    context.setCheckpointDir(fallback)
    return fallback


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared scratch folder that nothing has used before."""
    return f"{_own_scratch(spark)}/{label}-{uuid.uuid4().hex}"


def _own_scratch(spark: SparkSession) -> str:
    """The folder of this application below the shared one."""
    return f"{scratch_root(spark).rstrip('/')}/quarryline/{spark.sparkContext.applicationId}"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of the session, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="quarryline-package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as bundle:
        for source in sorted(package.rglob("*.py")):
            bundle.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


# Bytes of input one shuffle partition should stand for.
SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Size of a plan's result as Catalyst estimates it; nothing when it cannot tell."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size < 1 << 60 else None


def _source_bytes(df: DataFrame) -> int:
    """Size of the tables a plan reads; join estimates above them multiply and say too much."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


def shuffle_width(df: DataFrame) -> int:
    """Partitions for a shuffle of all rows: the session's setting, or more when the data asks for it."""
    configured = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sources, result = _source_bytes(df), estimated_bytes(df)
    known = sources if result is None else min(result, sources)
    # Sources whose size nobody knows are no reason for a width.
    wanted = known // SHUFFLE_PARTITION_BYTES if known < 1 << 60 else 0
    return max(configured, wanted)


def broadcast_is_certain(df: DataFrame) -> bool:
    """Whether Spark will broadcast this side of a join on its own, by its own size limit."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = estimated_bytes(df)
    return size is not None and size <= limit


@dataclass(frozen=True)
class FileEntry:
    """A file or folder; ``modified`` is wall time in the session time zone."""

    path: str
    is_dir: bool
    length: int
    modified: datetime


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hadoop_path


def _entry(spark: SparkSession, status) -> FileEntry:
    zone = ZoneInfo(spark.conf.get("spark.sql.session.timeZone"))
    modified = datetime.fromtimestamp(status.getModificationTime() / 1000, tz=zone)
    return FileEntry(
        status.getPath().toString(), status.isDirectory(), status.getLen(), modified.replace(tzinfo=None)
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _hadoop(spark, path)
    return fs.exists(hadoop_path)


def path_entry(spark: SparkSession, path: str) -> FileEntry | None:
    fs, hadoop_path = _hadoop(spark, path)
    return _entry(spark, fs.getFileStatus(hadoop_path)) if fs.exists(hadoop_path) else None


def list_folder(spark: SparkSession, path: str) -> list[FileEntry]:
    fs, hadoop_path = _hadoop(spark, path)
    return [_entry(spark, status) for status in fs.listStatus(hadoop_path)]


def expand_glob(spark: SparkSession, pattern: str) -> list[FileEntry]:
    """Paths matching a Hadoop glob; a plain path is its own only match."""
    fs, hadoop_path = _hadoop(spark, pattern)
    return [_entry(spark, status) for status in (fs.globStatus(hadoop_path) or [])]


def qualified(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _hadoop(spark, path)
    return fs.makeQualified(hadoop_path).toString()


def read_head(spark: SparkSession, path: str, size: int = 4096) -> str:
    """The first bytes of one file as text, for layout detection only."""
    fs, hadoop_path = _hadoop(spark, path)
    codec = spark.sparkContext._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(
        spark.sparkContext._jsc.hadoopConfiguration()
    ).getCodec(hadoop_path)
    stream = fs.open(hadoop_path)
    try:
        reader = codec.createInputStream(stream) if codec is not None else stream
        raw = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(
            spark.sparkContext._jvm.org.apache.commons.io.input.BoundedInputStream(reader, size)
        )
    finally:
        stream.close()
    return bytes(raw).decode("utf-8", errors="replace")


def remove_output(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _hadoop(spark, path)
    fs.delete(hadoop_path, True)


def move_file(spark: SparkSession, source: str, target: str) -> None:
    fs, source_path = _hadoop(spark, source)
    if not fs.rename(source_path, _hadoop(spark, target)[1]):
        raise OSError(f"could not move {source} to {target}")


def mark_complete(spark: SparkSession, path: str) -> None:
    """Put the success marker into an output folder."""
    fs, marker = _hadoop(spark, f"{path}/_SUCCESS")
    fs.create(marker, True).close()


def completed_output(spark: SparkSession, path: str) -> FileEntry | None:
    """A finished output: a plain file, or the success marker of a folder."""
    entry = path_entry(spark, path)
    return path_entry(spark, f"{path}/_SUCCESS") if entry is not None and entry.is_dir else entry


def java_class_exists(spark: SparkSession, name: str) -> bool:
    try:
        spark.sparkContext._jvm.java.lang.Class.forName(name)
    except Py4JJavaError:
        return False
    return True


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this application left in the shared scratch folder; call it when results are stored."""
    remove_output(spark, _own_scratch(spark))


def task_filesystem(path: str):
    """File system and location of a path for use inside tasks, where there is no Hadoop client."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))
