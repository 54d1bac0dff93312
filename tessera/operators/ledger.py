"""Ledger replay: last states, committed cost, admission under a ceiling."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def last_state(df: DataFrame, key: str, order: str, *columns: str) -> DataFrame:
    """The last row's columns of each key: one aggregate, no window."""
    last = df.groupBy(key).agg(F.max_by(F.struct(*columns), F.col(order)).alias("last"), F.count(F.lit(1)).alias("events"))
    return last.select(key, *[F.col(f"last.{c}").alias(c) for c in columns], "events")


def committed(df: DataFrame, key: str, order: str, cost: Column) -> DataFrame:
    """df with committed: the cost up to and with each event of its ledger."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("committed", F.sum(cost).over(w))


def admitted(df: DataFrame, key: str, order: str, cost: Column, ceiling: int) -> DataFrame:
    """df with committed and admitted: an event is admitted if the admitted cost before it and its own stay within the ceiling.

    A refused event adds nothing, so a later smaller one may pass; a null cost is refused; a negative one gives back.
    Each ledger is a fold in its order, streamed over sorted partitions: one number of state, whatever the ledger's length.
    """
    kept = list(df.schema.fields)
    rows = df.withColumn("_cost", cost.cast("long")).repartition(key).sortWithinPartitions(key, order)
    at = df.columns.index(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total = object(), 0
        for b in batches:
            sums, good = [], []
            for k, c in zip(b.column(at).to_pylist(), b.column(b.num_columns - 1).to_pylist(), strict=True):
                if k != own:
                    own, total = k, 0
                ok = c is not None and total + c <= ceiling
                total += c if ok else 0
                sums.append(total)
                good.append(ok)
            arrays = [*b.columns[:-1], pa.array(sums, pa.int64()), pa.array(good, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*b.schema.names[:-1], "committed", "admitted"])

    more = [T.StructField("committed", T.LongType()), T.StructField("admitted", T.BooleanType())]
    return rows.mapInArrow(run, T.StructType([*kept, *more]))


def chain_issues(df: DataFrame, key: str, sequence: str, previous: str, own_hash: str, payload: Column, hashed: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """(key, events, broken, issue): where a ledger's chain first fails: its sequence, its link to the event before, or its own hash; null if nowhere.

    The sequence counts from 0; the first event links to the empty text; a hash is SHA-256 of the link and the payload, or hashed(link, payload).
    """
    w = Window.partitionBy(key).orderBy(sequence)
    link = F.coalesce(F.lag(own_hash).over(w), F.lit(""))
    at = F.row_number().over(w) - 1
    hashed = hashed or (lambda p, q: F.sha2(F.concat(p, q), 256))
    issue = (
        F.when(~F.equal_null(F.col(sequence).cast("long"), at.cast("long")), "sequence")
        .when(~F.equal_null(F.coalesce(F.col(previous), F.lit("")), link), "link")
        .when(~F.equal_null(F.col(own_hash), hashed(F.coalesce(F.col(previous), F.lit("")), payload)), "hash")
    )
    seen = df.withColumn("_at", at.cast("long")).withColumn("_issue", issue)
    broken = F.min(F.when(F.col("_issue").isNotNull(), F.col("_at")))
    return seen.groupBy(key).agg(F.count(F.lit(1)).alias("events"), broken.alias("broken"), F.min_by("_issue", F.when(F.col("_issue").isNotNull(), F.col("_at"))).alias("issue"))


#: A ledger's last state and the paper's status it stands for.
STATES = {"failed": "failed", "source_unavailable": "unavailable", "budget_stopped": "budget_stopped", "not_started": "not_started", "retry_capped": "retry_capped"}


def paper_status(run: Column, has_run: Column, is_excluded: Column, state: Column, frozen: Column, folder: Column, states: dict[str, str] = STATES) -> tuple[Column, Column]:
    """(status, basis): what the run's record says, else the exclusions, the ledger's last state, the folder; reserve where nothing is known."""
    known = F.create_map(*[F.lit(v) for pair in states.items() for v in pair])
    of_state = F.try_element_at(known, state)
    no = lambda c: F.coalesce(c, F.lit(False))
    rules = [
        (no(has_run), F.coalesce(run, F.lit("success")), "run"),
        (no(is_excluded), F.lit("excluded"), "exclusions"),
        (of_state.isNotNull(), of_state, "ledger"),
        (no(state.isin("done", "skipped")), F.lit("missing_run_artifact"), "ledger"),
        (no(frozen), F.lit("not_started"), "frozen source"),
        (no(folder), F.lit("unavailable"), "folder"),
    ]
    status, basis = F.lit("reserve"), F.lit("absent")
    for when, to, where in reversed(rules):
        status, basis = F.when(when, to).otherwise(status), F.when(when, F.lit(where)).otherwise(basis)
    return status, basis


def status_priority(df: DataFrame, key: str, status: str, priority: list[str]) -> DataFrame:
    """Each key's status that stands first in priority; others come last, by name."""
    place = F.array_position(F.array(*map(F.lit, priority)), F.col(status))
    rank = F.struct(F.when(place == 0, F.lit(len(priority) + 1)).otherwise(place), F.col(status))
    return df.groupBy(key).agg(F.min_by(F.col(status), rank).alias(status), F.count(F.lit(1)).alias("n"))
