"""Daily metrics from a stream of scored posts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marquee.operators.aggregates import title_metrics
from marquee.schemas import METRICS
from marquee.sources.sinks import append_keyed

LATENESS = "1 day"


def windowed_metrics(scored: DataFrame, lateness: str = LATENESS, time: str = "tweet_datetime") -> DataFrame:
    """Metrics per title and day of a stream; a post seen twice within the lateness counts once.

    State is one row per open (title, day) and one key per post not yet too old.
    """
    once = scored.withWatermark(time, lateness).dropDuplicatesWithinWatermark(["title", "tweet_id"])
    daily = title_metrics(once.withColumn("day", F.window(time, "1 day")), ["day", "title"])
    return daily.withColumn("pred_date", F.to_date("day.start")).drop("day").select(*METRICS.columns)


def stream_metrics(
    scored: DataFrame, path: str, checkpoint: str, lateness: str = LATENESS, time: str = "tweet_datetime"
) -> StreamingQuery:
    """Append each day's metrics once its watermark has passed; a replayed batch adds nothing.

    Takes what is there and stops. ``checkpoint`` must be in the shared folder.
    """

    def write(batch: DataFrame, _: int) -> None:
        append_keyed(batch, METRICS, path, on_conflict="skip")

    return (
        windowed_metrics(scored, lateness, time)
        .writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
