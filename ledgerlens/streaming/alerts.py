"""Sustained-condition alerts on a stream."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

RUN = "since long, last long, steps long, fired boolean"
ROW = "since long, at long, steps long"


def _watched(
    steps: DataFrame, key: str, step: timedelta, hold: timedelta, at: str, condition: Column | None, ended: bool
) -> DataFrame:
    """Rows of ``ROW`` per key: one as a run has lasted ``hold`` or, with ``ended``, one as such a run is over.

    Times are milliseconds. A timer drops the state of a key once no step can continue its run.
    """
    width, least = (int(t.total_seconds() * 1000) for t in (step, hold))

    def advance(keys: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        since, last, n, fired = state.get if state.exists else (None, None, 0, False)
        rows = []
        if state.hasTimedOut:
            state.remove()
            if ended and last - since >= least:
                rows.append((keys[0], since, last, n))
        else:
            for now in sorted(int(t) for batch in batches for t in batch["ms"]):
                if last is not None and now <= last:
                    continue
                if last is None or now - last > width:
                    if ended and last is not None and last - since >= least:
                        rows.append((keys[0], since, last, n))
                    since, n, fired = now, 0, False
                last, n = now, n + 1
                if not ended and not fired and now - since >= least:
                    fired = True
                    rows.append((keys[0], since, now, n))
            if last is not None:
                state.update((since, last, n, fired))
                state.setTimeoutTimestamp(max(last + width, state.getCurrentWatermarkMs()) + 1)
        if rows:
            yield pd.DataFrame(rows, columns=[key, "since", "at", "steps"])

    met = steps
    if condition is not None:
        # one predicate that names the event time stays above the watermark, which has to see all steps
        met = steps.filter(condition | F.col(at).isNull()).filter(F.col(at).isNotNull())
    key_type = met.schema[key].dataType.simpleString()
    rows = (
        met.select(key, at, F.unix_millis(at).alias("ms"))
        .groupBy(key)
        .applyInPandasWithState(advance, f"{key} {key_type}, {ROW}", RUN, "append", GroupStateTimeout.EventTimeTimeout)
    )
    return rows.withColumns({"since": F.timestamp_millis("since"), "at": F.timestamp_millis("at")})


def sustained_stream(
    steps: DataFrame, key: str, step: timedelta, hold: timedelta, at: str = "at", condition: Column | None = None
) -> DataFrame:
    """(key, since, fired_at), once per unbroken run, at the step at which it has lasted ``hold``.

    ``steps`` has one row per key and evaluation step, with a watermark on ``at``, and ``condition`` tells at which it held
    (None: at all). It is a stream over the table that a windowed aggregation appends its closed steps to,
    because Spark takes no such state operator behind an aggregation in one query. The state is four
    values per key, dropped once the watermark has passed the step that could continue the run; a micro-batch brings a
    key as many rows as steps have closed. Steps not later than the last one seen are ignored.
    """
    fired = _watched(steps, key, step, hold, at, condition, ended=False)
    return fired.select(key, "since", F.col("at").alias("fired_at"))


def ended_runs(
    steps: DataFrame, key: str, step: timedelta, hold: timedelta, at: str = "at", condition: Column | None = None
) -> DataFrame:
    """(key, since, until, steps) of unbroken runs that lasted at least ``hold``, each as soon as it is over.

    The batch form is ``monitor.sustained``. A run is over at a gap, or when the watermark passes the step that would have
    continued it, so a key that falls silent is reported too. For the input see ``sustained_stream``.
    """
    runs = _watched(steps, key, step, hold, at, condition, ended=True)
    return runs.select(key, "since", F.col("at").alias("until"), "steps")
