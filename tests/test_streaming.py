"""Stateless operators on a streaming DataFrame give what they give on a table."""

from conftest import rows

from quarryline.functions import calendar, dates
from quarryline.operators import columns, filters


def _work(events):
    kept = filters.filter_different(events, "event_type", "click")
    kept = columns.add_columns(kept, [{"name": "Layer", "value": "Test"}])
    kept = kept.withColumn("week", calendar.calculated_date("ts", "CalculatedDate_CYCW_-1", 7))
    kept = dates.add_weekday_columns(kept, ["ts"])
    return kept.select("event_id", "event_type", "Layer", "week", "Weekday for ts")


def test_same_result_on_a_stream(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    stream = spark.readStream.schema(table.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    query = _work(stream).writeStream.format("memory").queryName("streamed_events").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert rows(spark.table("streamed_events")) == rows(_work(table))
