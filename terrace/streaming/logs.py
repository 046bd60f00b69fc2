"""Pageview logs as a stream: files that arrive in a folder are parsed and summed into windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "ts timestamp, lang string, title string, views bigint"


def arriving(spark: SparkSession, folder: str, files_per_trigger: int = 16) -> DataFrame:
    """Parquet files of (ts, lang, title, views) as they come."""
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def windowed_views(stream: DataFrame, late: str = "1 day", window: str = "1 day") -> DataFrame:
    """Views per window, language and title; rows later than the watermark are left out."""
    per = stream.withWatermark("ts", late).groupBy(F.window("ts", window), "lang", "title").agg(F.sum("views").alias("views"))
    return per.select(F.col("window.start").alias("since"), "lang", "title", "views")


def into_parquet(result: DataFrame, target: str, checkpoint: str):
    """Finished windows are appended once; the query ends when what has arrived is read."""
    return result.writeStream.outputMode("append").format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
