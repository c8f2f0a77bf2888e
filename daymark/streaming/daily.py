"""Daily counts of a stream of visits: each day is given out once, when it is closed.

A day is closed when events later than its end by more than the allowed delay have come. Repeats of a
visit within the delay are dropped, events of closed days too, as in a batch that leaves out the
unfinished day. State (open days, visits seen of late) lives in the checkpoint of the stream, so a
stream that stops and starts again goes on where it was.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.schema import DATE, KEY, TARGET, TIME, require_columns

#: How late an event may come.
DELAY = "1 day"


def event_time(column: str) -> Column:
    """The moment whose UTC clock shows a time without zone; event times must be moments.

    Put together from the parts of the clock, so the session's zone has no say.
    """
    clock = F.col(f"`{column}`")
    seconds = (F.extract(F.lit("SECOND"), clock) * 1_000_000).cast("bigint")
    minutes = F.datediff(clock, F.lit("1970-01-01").cast("date")).cast("bigint") * 1440 + F.hour(clock) * 60 + F.minute(clock)
    return F.timestamp_micros(minutes * 60_000_000 + seconds)


def streaming_daily_counts(
    visits: DataFrame, series_cols: Sequence[str] = (), keys: Sequence[str] = (KEY, TIME), time_col: str = TIME, delay: str = DELAY
) -> DataFrame:
    """Closed days of a stream (or batch) of visits: series, Date, count. Visits without a time are left out.

    `keys` name a visit; a time among them counts to the microsecond.
    """
    require_columns(visits, [*series_cols, *keys, time_col], "visits")
    timed = visits.select(*dict.fromkeys([*series_cols, *keys, time_col])).where(F.col(time_col).isNotNull())
    timed = timed.withColumn("_at", event_time(time_col)).withWatermark("_at", delay)
    named = [*dict.fromkeys([*series_cols, *keys])]
    once = timed.dropDuplicatesWithinWatermark(named) if visits.isStreaming else timed.dropDuplicates(named)
    counted = once.groupBy(*series_cols, F.window("_at", "1 day").alias("_day")).agg(F.count("*").alias(TARGET))
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.unix_micros("_day.start") / 86_400_000_000).cast("int"))
    return counted.select(*series_cols, day.alias(DATE), TARGET)


def write_closed_days(daily: DataFrame, path: str, checkpoint: str) -> None:
    """Process all that has come so far and add the days that it closes to a parquet table."""
    stream = daily.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    query = stream.trigger(availableNow=True).start()
    query.awaitTermination()
