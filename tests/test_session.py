"""Settings and shuffle sizes follow the data."""

from pyspark.sql import functions as F

from quarryline import runtime, session


def test_recommended_settings():
    small = session.recommended_settings(10**6, 8)
    assert small["spark.sql.shuffle.partitions"] == "8"
    large = session.recommended_settings(10**14, 8_000)
    assert large["spark.sql.shuffle.partitions"] == str(10**14 // runtime.SHUFFLE_PARTITION_BYTES)
    assert large["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_shuffle_width(spark, sf_dir, monkeypatch):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    assert runtime.estimated_bytes(lines) > 0
    assert runtime.shuffle_width(lines) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    joined = lines.join(lines.withColumnsRenamed({c: f"r_{c}" for c in lines.columns}), F.expr("l_orderkey = r_l_orderkey"))
    monkeypatch.setattr(runtime, "SHUFFLE_PARTITION_BYTES", 10**8)
    assert runtime.estimated_bytes(joined) > 10**9
    assert runtime.shuffle_width(joined) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(runtime, "SHUFFLE_PARTITION_BYTES", 1000)
    assert runtime.shuffle_width(lines) > 50
    unknown = spark.createDataFrame(spark.sparkContext.parallelize([(1,)]), "a int")
    assert runtime.shuffle_width(unknown) == int(spark.conf.get("spark.sql.shuffle.partitions"))
