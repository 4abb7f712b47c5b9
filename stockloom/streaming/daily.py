"""The daily price update, as a batch and as a stream."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from stockloom.functions.columns import on_day
from stockloom.operators.build import known
from stockloom.operators.upsert import last_write_wins, merge_batch
from stockloom.session import work_dir
from stockloom.sources.store import append_batch, latest, merge_prices

PRICE_KEY = ("symbol", "date")


def daily_update(
    current: DataFrame, extract: DataFrame, company: DataFrame, as_of: str | date, version: Sequence[str] = ()
) -> DataFrame:
    """The price table after the day's extract has been written over it."""
    day = known(on_day(extract, as_of), company)
    return merge_batch(current, day, PRICE_KEY, version)


def stream_update(
    stream: DataFrame,
    log: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame],
    keys: Sequence[str] = PRICE_KEY,
    version: Sequence[str] = (),
) -> None:
    """Write all files now waiting on a stream to the log, one batch each.

    Any date is taken and replaces its key, so there is no watermark. A batch
    run again after a failure rewrites its own folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = last_write_wins(prepare(batch), keys, version, keep_version=True)
        append_batch(rows, log, batch_id)

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def price_stream(
    spark: SparkSession, folder: str, schema, files: str = "*.parquet", files_per_batch: int | None = None
) -> DataFrame:
    """The parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.parquet(folder)


def streamed_prices(
    stream: DataFrame, prepare: Callable[[DataFrame], DataFrame], version: Sequence[str] = ()
) -> DataFrame:
    """Run the stream into a fresh log of the shared folder and read its latest rows."""
    spark = stream.sparkSession
    root = work_dir(spark, "price_log")
    log = os.path.join(root, "log")
    stream_update(stream, log, os.path.join(root, "checkpoint"), prepare, PRICE_KEY, version)
    return latest(spark, log, PRICE_KEY, version)


def merge_batch_once(
    batch: DataFrame,
    batch_id: int,
    root: str,
    prepare: Callable[[DataFrame], DataFrame],
    version: Sequence[str] = (),
    stream: str = "prices",
) -> int:
    """One batch of a stream over the stored prices; a batch already stored changes nothing.

    The store records the stream's name and the batch's number with the version that the batch made, in one write: a
    batch that broke off is merged anew, one that was merged is not, however often a stream hands it on. A
    late day replaces its key in its own month, and no other month is read or written.
    """
    rows = last_write_wins(prepare(batch), PRICE_KEY, version)
    return merge_prices(rows, root, mark=f"{stream}:{batch_id}")


def stream_into_graph(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame],
    version: Sequence[str] = (),
    name: str = "prices",
) -> None:
    """All files now waiting on a stream, batch by batch, over the stored graph's prices."""
    query = (
        stream.writeStream.foreachBatch(lambda batch, number: merge_batch_once(batch, number, root, prepare, version, name))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
