"""Pickle files: record batches pickled by the tasks into Spark pickle files.

Unpickling runs code, so only files this library wrote should be read.
"""

from __future__ import annotations

import bz2
import gzip
import io
import json
import lzma
import pickle
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarryline.operators.columns import union_tables
from quarryline.runtime import expand_glob, list_folder, mark_complete, read_head, ship_package
from quarryline.sources.formats import SOURCE_FILE_COLUMN

_SCHEMA_FOLDER = "_schema"


def _zip(blob: bytes) -> bytes:
    target = io.BytesIO()
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("batch.pickle", blob)
    return target.getvalue()


def _unzip(blob: bytes) -> bytes:
    with zipfile.ZipFile(io.BytesIO(blob)) as archive:
        return archive.read(archive.namelist()[0])


# Codec -> (compress, decompress, first bytes of compressed data).
_CODECS = {
    "gzip": (gzip.compress, gzip.decompress, b"\x1f\x8b"),
    "bz2": (bz2.compress, bz2.decompress, b"BZh"),
    "xz": (lzma.compress, lzma.decompress, b"\xfd7zXZ\x00"),
    "zip": (_zip, _unzip, b"PK\x03\x04"),
}


def _decompressed(blob: bytes) -> bytes:
    for _, decompress, magic in _CODECS.values():
        if blob.startswith(magic):
            return decompress(blob)
    return blob


def write_pickled(df: DataFrame, path: str, codec: str) -> None:
    """Write each Arrow batch as one pickled, compressed list of dictionaries.

    The success marker comes last, after the data and the schema.
    """
    compress = _CODECS[codec][0] if codec != "none" else bytes

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blob = compress(pickle.dumps(batch.to_pylist(), protocol=4))
            yield pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], ["blob"])

    ship_package(df.sparkSession)
    packed = df.mapInArrow(pack, "blob binary").rdd.map(lambda row: bytes(row.blob))
    packed.saveAsPickleFile(f"{path}/data", batchSize=1)
    spark = df.sparkSession
    schema = spark.createDataFrame([(df.schema.json(),)], "value string").coalesce(1)
    schema.write.mode("overwrite").text(f"{path}/{_SCHEMA_FOLDER}")
    mark_complete(spark, path)


def _stored_schema(spark: SparkSession, folder: str) -> StructType:
    for entry in list_folder(spark, f"{folder}/{_SCHEMA_FOLDER}"):
        if entry.path.rsplit("/", 1)[-1].startswith("part-"):
            return StructType.fromJson(json.loads(read_head(spark, entry.path, 1 << 24)))
    raise ValueError(f"{folder} was not written as pickle by this library")


def _read_folder(spark: SparkSession, folder: str) -> DataFrame:
    schema = _stored_schema(spark, folder)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow_schema = to_arrow_schema(schema)
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                rows = pickle.loads(_decompressed(blob))
                yield pa.RecordBatch.from_pylist(rows, schema=arrow_schema)

    ship_package(spark)
    blobs = spark.sparkContext.pickleFile(f"{folder}/data").map(lambda blob: (blob,))
    frame = spark.createDataFrame(blobs, "blob binary").mapInArrow(unpack, schema)
    return frame.withColumn(SOURCE_FILE_COLUMN, F.lit(folder.rstrip("/").rsplit("/", 1)[-1]))


def read_pickled(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Read folders written by :func:`write_pickled`; columns they do not share are null."""
    folders = [entry.path for path in paths for entry in expand_glob(spark, path)]
    if not folders:
        raise FileNotFoundError(f"no pickle output matches {paths}")
    return union_tables([_read_folder(spark, folder) for folder in folders])
