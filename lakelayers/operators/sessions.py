"""Sessions: runs of events of a key that follow each other within a gap."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPAN = timedelta(days=1)


def sessions(df: DataFrame, keys: Sequence[str], time: str, gap: timedelta, span: timedelta = SPAN) -> DataFrame:
    """The keys, ``session_start``, ``session_end`` (the last event) and ``events`` of every session.

    An event belongs to the session before it if it comes at most ``gap`` after that session's last one.
    Null keys are a key of their own; rows without a time are left out. Times are timestamps.

    A stream, which needs a watermark on ``time``, keeps open sessions in its state, merges those that
    later rows connect and gives each out once it can grow no more. A batch is cut into spans of time
    first: sessions are built by key and span, in as many tasks as a hot key has spans, and then only the
    at most two sessions of a span that may go on beyond it are merged with those of its neighbours.
    """
    if df.isStreaming:
        found = df.groupBy(F.session_window(time, _interval(gap)).alias("_session"), *keys)
        return _measured(found, time).select(*keys, "session_start", "session_end", "events")
    micros, width = gap // timedelta(microseconds=1), max(span, gap) // timedelta(microseconds=1)
    at = F.unix_micros(time)
    cut = df.filter(F.col(time).isNotNull()).withColumn("_span", F.floor(at / F.lit(width)).cast("long"))
    cut = cut.groupBy(F.session_window(time, _interval(gap)).alias("_session"), *keys, "_span")
    parts = _measured(cut, time).select(*keys, "_span", "session_start", "session_end", "events")
    early = F.unix_micros("session_start") - F.col("_span") * width <= micros
    late = (F.col("_span") + 1) * width - F.unix_micros("session_end") <= micros
    columns = [*keys, "session_start", "session_end", "events"]
    whole = parts.filter(~(early | late)).select(*columns)
    return whole.unionByName(_stitched(parts.filter(early | late).select(*columns), keys, micros))


def _measured(grouped, time: str) -> DataFrame:
    return grouped.agg(
        F.min(time).alias("session_start"), F.max(time).alias("session_end"), F.count(F.lit(1)).alias("events")
    )


def _stitched(parts: DataFrame, keys: Sequence[str], micros: int) -> DataFrame:
    names = ", ".join(f"`{key}`" for key in keys)
    before = f"max(unix_micros(session_end)) over (partition by {names} order by session_start rows between unbounded preceding and 1 preceding)"
    begins = parts.withColumn("_before", F.expr(before))
    begins = begins.withColumn("_new", F.expr(f"cast(coalesce(unix_micros(session_start) - _before > {micros}L, true) as int)"))
    numbered = begins.withColumn("_number", F.expr(f"sum(_new) over (partition by {names} order by session_start rows unbounded preceding)"))
    return numbered.groupBy(*keys, "_number").agg(
        F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"), F.sum("events").alias("events")
    ).drop("_number")


def _interval(gap: timedelta) -> str:
    return f"{gap // timedelta(microseconds=1)} microseconds"
