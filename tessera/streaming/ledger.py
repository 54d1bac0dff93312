"""Admission under a ceiling on a stream: one number of state for each ledger."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState


def admit_stream(events: DataFrame, ceiling: int) -> DataFrame:
    """events(ledger, event_id, cost), streamed -> (ledger, event_id, cost, committed, admitted).

    As operators.ledger.admitted within each micro-batch, by event_id, and from batch to batch by the state: what is committed so
    far. An event that comes in a later batch is judged after those of earlier ones, whatever its id. A null cost is refused.
    """

    def fold(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        total = state.get[0] if state.exists else 0
        rows = pd.concat(parts).sort_values("event_id", kind="stable")
        sums, good = [], []
        for c in rows["cost"].astype("Int64"):
            ok = c is not pd.NA and total + int(c) <= ceiling
            total += int(c) if ok else 0
            sums.append(total)
            good.append(ok)
        state.update((total,))
        yield rows.assign(committed=sums, admitted=good)[["ledger", "event_id", "cost", "committed", "admitted"]]

    return events.groupBy("ledger").applyInPandasWithState(
        fold, "ledger string, event_id long, cost long, committed long, admitted boolean", "total long", "append", "NoTimeout"
    )
