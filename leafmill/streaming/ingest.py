"""An extension of our own: structured streaming over an event table, with the batch query it must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LATE, WIDTH = "10 minutes", "1 hour"


def read_events(spark: SparkSession, path: str, schema, files_per_trigger: int = 8) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def hourly(events: DataFrame, late: str = LATE, width: str = WIDTH) -> DataFrame:
    """Counts by hour and type of events with distinct ids. On a stream, ids are remembered, and late rows dropped, by the watermark."""
    rows = events.withColumn("at", F.col("ts").cast("timestamp"))
    rows = rows.withWatermark("at", late).dropDuplicatesWithinWatermark(["event_id"]) if events.isStreaming else rows.dropDuplicates(["event_id"])
    counted = rows.groupBy(F.window("at", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return counted.select(F.col("w.start").alias("hour"), "event_type", "n", F.round("total", 6).alias("total"))


def sessions(events: DataFrame, pause: str = "30 minutes", late: str = LATE) -> DataFrame:
    """Runs of each user's events without a longer pause; on a stream a session closes when the watermark passes it."""
    rows = events.withColumn("at", F.col("ts").cast("timestamp"))
    if events.isStreaming:
        rows = rows.withWatermark("at", late)
    out = rows.groupBy(F.session_window("at", pause).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return out.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def resumed(stream: DataFrame, target: str, key: list[str]):
    """A foreachBatch sink that appends rows whose key the target hasn't got."""

    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        new = batch.dropDuplicates(key)
        try:
            done = spark.read.parquet(target).select(*key)
        except Exception as missing:  # the first batch finds no table
            if "PATH_NOT_FOUND" not in str(missing) and "UNABLE_TO_INFER_SCHEMA" not in str(missing):
                raise
        else:
            new = new.join(done, key, "left_anti")
        new.write.mode("append").parquet(target)

    return stream.writeStream.foreachBatch(write)


def drain(stream: DataFrame, name: str, checkpoint: str) -> DataFrame:
    """Run what there is to a table in memory; for tests and small results."""
    query = stream.writeStream.format("memory").queryName(name).outputMode("complete").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.table(name)
