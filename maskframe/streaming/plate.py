"""Plates field by field: a file stream measures each field as it arrives, once, and a plate is done when none is missing.

`progress` keeps a state for each plate: the fields seen, whether all have come, and since when it waits. A field that comes again is
refused, a plate is told when it is complete, and one that waits too long is told with what it has."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.regions import objects


def missing(expected: DataFrame, written: DataFrame, key: list[str]) -> DataFrame:
    """Expected fields that weren't written."""
    return expected.join(written.select(*key).distinct(), key, "left_anti")


def unexpected(expected: DataFrame, written: DataFrame, key: list[str]) -> DataFrame:
    """Written fields that weren't expected."""
    return missing(written, expected, key)


def measure_stream(spark: SparkSession, labels_dir: str, schema, images: DataFrame, out: str, checkpoint: str) -> None:
    """Measures each new file of labels once and appends its objects; a batch that is run again writes to the same folder, so nothing doubles."""

    def write(batch: DataFrame, number: int) -> None:
        objects(batch, images).write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream = spark.readStream.schema(schema).parquet(labels_dir)
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def finalize(spark: SparkSession, expected: DataFrame, written: DataFrame, key: list[str]) -> None:
    """An error if the plate isn't whole."""
    gone, extra = missing(expected, written, key).limit(5).collect(), unexpected(expected, written, key).limit(5).collect()
    if gone or extra:
        raise ValueError(f"plate isn't whole: missing {gone}, unexpected {extra}")


PROGRESS = "plate long, fields long, refused long, missing long, event string"
STATE = "seen array<long>, expected long, complete boolean"


def progress(arrivals: DataFrame, patience_ms: int = 3_600_000, lateness: str = "10 minutes") -> DataFrame:
    """Of a stream of fields (plate, field, expected: how many the plate has; at: when) a row for each plate and batch that brought it
    some: how many new fields, how many refused, how many are missing still, and the event: `open`, `complete` (once) or, when no
    field came for `patience_ms` of event time, `timeout`. What a plate's state holds are its fields' numbers; it goes with the
    plate's timeout, complete or not. Null plates and fields are left out."""

    def track(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, expected, complete = state.get if state.exists else ([], 0, False)
        if state.hasTimedOut:
            state.remove()
            if not complete:
                yield pd.DataFrame([(key[0], 0, 0, expected - len(seen), "timeout")], columns=["plate", "fields", "refused", "missing", "event"])
            return
        rows, known, latest = 0, set(seen), 0
        before = len(known)
        for part in batches:
            rows += len(part)
            known.update(int(f) for f in part["field"])
            expected = max(expected, int(part["expected"].max()))
            latest = max(latest, int(part["at"].max().timestamp() * 1000))
        event = "complete" if not complete and len(known) >= expected else "open"
        state.update((sorted(known), expected, complete or event == "complete"))
        state.setTimeoutTimestamp(max(latest + patience_ms, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame([(key[0], len(known) - before, rows - len(known) + before, max(0, expected - len(known)), event)], columns=["plate", "fields", "refused", "missing", "event"])

    rows = arrivals.filter("plate is not null and field is not null").withWatermark("at", lateness)
    return rows.groupBy(F.col("plate")).applyInPandasWithState(track, PROGRESS, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def followed(arrivals: DataFrame, out: str, checkpoint: str, **options) -> DataFrame:
    """Follows a stream of fields until all that is there has been seen, appending progress to a folder; run again with the same
    checkpoint it goes on where it stopped. All that was told so far."""
    spark = arrivals.sparkSession
    query = progress(arrivals, **options).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(PROGRESS).parquet(out)
