"""Run the report for date folders as their files arrive.

A file stream notices new files. Which of a date's required files have been seen is the
stream's state, keyed by date: a number per date, whatever else its folder holds. A date
is reported in the batch that brings its last required file, and again when a later batch
brings files for it; no folder is listed. A date that waits too long for a file is told
as late. The outputs replace only the dates of the batch and the batch's own
dimension version, so a repeated batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from supplyview.plans.runs import Options, report
from supplyview.sources.folders import REQUIRED_FILES, date_text, is_date_text

# Fixed columns of Spark's binary file source.
BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"
STATUS = "date string, status string, missing string"
READY, LATE = "Ready", "Missing files"
STORE_CONF = "spark.sql.streaming.stateStore.providerClass"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY_MS = 24 * 3600 * 1000


def stream_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, date) of every file that arrives below ``root``; contents are not read."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE)
        .option("recursiveFileLookup", "true")
        .load(root)
    )
    return files.select("path", date_text(F.col("path")).alias("date")).filter(
        F.col("date") != ""
    )


class FilesOfDate(StatefulProcessor):
    """Per date: which required files have come (a bit each), and until when the others may."""

    def __init__(self, required: Sequence[str], wait_ms: int):
        self.required, self.wait_ms = tuple(required), wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "files long, due long")

    def _row(self, date: str, status: str, seen: int) -> pd.DataFrame:
        missing = [f for i, f in enumerate(self.required) if not seen >> i & 1]
        return pd.DataFrame({"date": [date], "status": [status], "missing": [", ".join(missing)]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        seen, due = self.seen.get() if self.seen.exists() else (0, 0)
        before, now = seen, 0
        for frame in rows:
            now = max(now, int(frame["at"].max()))
            for name in frame["file"]:
                if name in self.required:
                    seen |= 1 << self.required.index(name)
        complete = seen == (1 << len(self.required)) - 1
        if due and complete:
            self.handle.deleteTimer(due)
            due = 0
        elif not due and not complete:
            due = now + self.wait_ms
            self.handle.registerTimer(due)
        if (seen, due) != (before, 0) or not self.seen.exists():
            self.seen.update((seen, due))
        if complete:
            yield self._row(key[0], READY, seen)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        seen, _ = self.seen.get()
        self.seen.update((seen, 0))
        yield self._row(key[0], LATE, seen)

    def close(self) -> None:
        pass


def date_status(
    files: DataFrame, required: Sequence[str], wait_ms: int = DAY_MS
) -> DataFrame:
    """(date, status, missing) of a stream of (path, date): ``Ready`` whenever files come for a date
    that has all it needs, ``Missing files`` once when one is missing ``wait_ms`` after the first
    came, and again after further files and as long a wait; told in the batch that comes next."""
    # Time is that of the batches, so no file is ever too old; it moves on with each batch.
    named = files.filter(is_date_text(F.col("date"))).select(
        "date", F.regexp_extract("path", r"([^/]+)$", 1).alias("file"),
        F.current_timestamp().alias("arrived"),
    ).withWatermark("arrived", "0 seconds").withColumn("at", F.unix_millis("arrived"))
    return named.groupBy("date").transformWithStateInPandas(
        FilesOfDate(required, wait_ms), STATUS, "Update", "EventTime"
    )


def report_new_dates(
    spark: SparkSession,
    root: str,
    dimension_path: str,
    output: str,
    checkpoint: str,
    options: Options = Options(),
    usage_file: str | None = None,
    required: Sequence[str] | None = None,
    wait_ms: int = DAY_MS,
) -> StreamingQuery:
    """Process everything that has arrived, then stop; run again to go on.

    ``required``: the files a date waits for, by default those of the layout. Dates
    that wait longer than ``wait_ms`` stand in ``late`` below ``output``.
    """
    if required is None:
        required = REQUIRED_FILES["split" if options.layout == "split" else "combined"]
    spark.conf.set(STORE_CONF, STORE)

    def process(batch: DataFrame, batch_id: int) -> None:
        # One row per date the batch touches; kept, as reading it again would run the state again.
        told = batch.persist()
        try:
            late = told.filter(F.col("status") == LATE)
            if not late.isEmpty():
                late.write.mode("overwrite").option("header", True).csv(f"{output}/late/batch={batch_id}")
            ready = told.filter(F.col("status") == READY).select("date").distinct().orderBy("date")
            dates = [r["date"] for r in ready.collect()]
        finally:
            told.unpersist()
        if dates:
            report(
                spark, root, dimension_path, output, f"batch-{batch_id}", again=True,
                dates=dates, usage_file=usage_file, options=options,
            )

    return (
        date_status(stream_files(spark, root), required, wait_ms)
        .writeStream.foreachBatch(process)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
