"""Streams: folders watched for new files, resumable upserts, incremental deduplication, windows with lateness."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from siltloom.common import exists
from siltloom.functions import similarity
from siltloom.sources.files import source_files


def watch(spark: SparkSession, root: str, pattern: str = "*.png") -> DataFrame:
    """New files of a folder as they come; what is there when it starts counts as new once."""
    return source_files(spark, root, pattern, stream=True)


def drain(df: DataFrame, folder: str, mode: str = "append") -> DataFrame:
    """All that is available now, then the stream ends; the result is read from files below ``folder``, never held by the driver.

    Appended rows go through the file sink, whose log makes a batch that comes again count once; in complete mode each
    batch's result replaces the last one.
    """
    spark, result = df.sparkSession, f"{folder}/result"
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
    if mode == "append":
        query = writer.format("parquet").option("path", result).start()
    else:
        spark.createDataFrame([], df.schema).write.mode("overwrite").parquet(result)
        query = writer.foreachBatch(lambda rows, number: rows.write.mode("overwrite").parquet(result)).start()
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(result)


def run_into(df: DataFrame, path: str, checkpoint: str, work: Callable[[DataFrame], DataFrame], key: str, now: bool = True) -> StreamingQuery:
    """Processes new rows in batches and appends the results whose key is not stored yet: a batch that comes again after a
    failure adds nothing twice."""

    def batch(rows: DataFrame, number: int) -> None:
        made = work(rows).dropDuplicates([key])
        spark = rows.sparkSession
        if exists(spark, path):
            made = made.join(spark.read.parquet(path).select(key), key, "left_anti")
        made.write.mode("append").parquet(path)

    writer = df.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if now else writer.trigger(processingTime="1 second")).start()


def first_texts(df: DataFrame, text: str = "text") -> DataFrame:
    """Rows of a stream whose text was not seen before, by md5."""
    return df.withColumn("__h", F.md5(text)).dropDuplicates(["__h"]).drop("__h")


def simhash_stream(df: DataFrame, key: str = "id", text: str = "text", distance: int = 3, bits: int = 16) -> DataFrame:
    """(id, kept): rows of a stream, dropped where an earlier kept signature is within ``distance`` bits.

    State is per value of the signature's top band, so a pair that differs in that band alone is only found by the batch
    operator; the bound is the number of kept signatures of one band value.
    """
    from siltloom.operators.dedup import simhash_column

    signed = df.select(F.col(key).alias("id"), simhash_column(F.col(text)).alias("sig")).withColumn("band", F.shiftright("sig", 64 - bits))

    def step(band: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kept = list(state.get[0]) if state.exists else []
        for f in frames:
            f = f.sort_values("id")
            flags = []
            for s in f["sig"]:
                near = any(similarity.hamming(int(s) & (1 << 64) - 1, k & (1 << 64) - 1) <= distance for k in kept)
                flags.append(not near)
                if not near:
                    kept.append(int(s))
            yield pd.DataFrame({"id": f["id"], "kept": flags})
        state.update((kept,))

    return signed.groupBy("band").applyInPandasWithState(step, f"id {dict(df.dtypes)[key]}, kept boolean", "kept array<long>", "append", GroupStateTimeout.NoTimeout)


def windows(events: DataFrame, time: str, width: str = "1 hour", late: str = "2 hours", by: str = "event_type") -> DataFrame:
    """(start, by, events): counts per tumbling window, closed when the watermark passes it."""
    timed = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    return timed.groupBy(F.window(time, width).alias("w"), by).agg(F.count("*").alias("events")).select(F.col("w.start").alias("start"), by, "events")


def new_listing(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Names in the current listing that the previous one lacks."""
    return current.subtract(previous)
