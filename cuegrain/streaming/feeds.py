"""Append-only feeds: quota counts, sessions, and keyed replacement."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..sources.keyed import KeyedTable


def quota_counts(feed: DataFrame, *, time: str, model: str, zone: str = "America/Los_Angeles", late: str = "1 hour") -> DataFrame:
    """Requests by model and day of the zone, final once the watermark passes the day; later rows are left out.

    The day's window is taken on the zone's wall clock.
    """
    local = feed.withColumn("_local", F.from_utc_timestamp(F.col(time), zone)).withWatermark("_local", late)
    return local.groupBy(F.window("_local", "1 day"), F.col(model).alias("model")).agg(F.count(F.lit(1)).alias("requests")).select(F.to_date("window.start").alias("quota_day"), "model", "requests")


def sessions(feed: DataFrame, *, time: str, entity: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """(entity, start, end, n): rows of an entity less than ``gap`` apart."""
    w = feed.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), F.col(entity)).agg(F.count(F.lit(1)).alias("n"))
    return w.select(entity, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def rolling_captions(feed: DataFrame, *, entity: str, time: str, late: str = "1 hour", wait: str = "2 hours") -> DataFrame:
    """(entity, t_start, t_end, text): captions that grow word by word, as :func:`captions.collapse_rolling` makes them one, from a feed of cues (entity, index, t_start, t_end, text).

    The state of an entity is its open caption. A caption comes out once a cue begins anew, or when
    the watermark is ``wait`` beyond the entity's last row. Cues of an entity must arrive in their order;
    within a batch they are put in it.
    """
    kind = dict(feed.dtypes)[entity]
    out = f"{entity} {kind}, t_start double, t_end double, text string"
    gap = pd.Timedelta(wait) // pd.Timedelta("1ms")

    def grow(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        open_ = list(state.get) if state.exists else None  # t_start, t_end, text without blanks, text
        done, last = [], state.getCurrentWatermarkMs()
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame([(key[0], open_[0], open_[1], open_[3])], columns=[entity, "t_start", "t_end", "text"])
            return
        for frame in frames:
            last = max(last, int(frame[time].max().timestamp() * 1000))
            for start, end, text in frame.sort_values("index")[["t_start", "t_end", "text"]].itertuples(index=False):
                bare = text.replace(" ", "")
                if open_ is not None and bare.startswith(open_[2]):
                    open_[1] = end
                    if bare != open_[2]:  # the earliest text of those that say the same stays
                        open_[2:] = [bare, text]
                else:
                    if open_ is not None:
                        done.append((key[0], open_[0], open_[1], open_[3]))
                    open_ = [start, end, bare, text]
        if open_ is not None:
            state.update(tuple(open_))
            state.setTimeoutTimestamp(last + gap)
        yield pd.DataFrame(done, columns=[entity, "t_start", "t_end", "text"])

    rows = feed.filter(F.col("text").isNotNull()).withWatermark(time, late)
    return rows.groupBy(entity).applyInPandasWithState(grow, out, "t_start double, t_end double, bare string, text string", "append", GroupStateTimeout.EventTimeTimeout)


def replace_by_key(feed: DataFrame, table: KeyedTable, checkpoint: str) -> StreamingQuery:
    """Write all that is available, a batch at a time: the rows of a batch take the place of all rows of their keys.

    A batch that is tried again after a failure replaces what it wrote itself, so nothing is repeated.
    """
    return feed.writeStream.foreachBatch(lambda rows, _: table.replace(rows)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
