import pytest

from skyloom.operators.weather import hourly_agg
from skyloom.streaming.hourly import hourly_stream


def test_stream_gives_the_batch_hours(spark, tmp_path):
    rows = [(f"2024-01-01 {h:02d}:{m:02d}:00", 270.0 + h + m) for h in range(6) for m in (0, 30)]
    df = spark.createDataFrame(rows, "t string, temperature double").selectExpr(
        "t::timestamp AS measurement_time", "temperature"
    )
    for day, part in (("a", "hour(measurement_time) < 4"), ("b", "hour(measurement_time) >= 4")):
        df.where(part).coalesce(1).write.parquet(str(tmp_path / "in" / day))
    source = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    query = (
        hourly_stream(source, lateness="1 hour").writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "state")).option("path", str(tmp_path / "out"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    assert query.exception() is None
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))
    batch = sorted(map(tuple, hourly_agg(df).collect()))
    # The hours the watermark (05:30 less one hour) has passed are final.
    assert got == batch[:4]


def test_batch_input_is_refused(spark):
    df = spark.createDataFrame([(1.0,)], "temperature double")
    with pytest.raises(ValueError):
        hourly_stream(df)
