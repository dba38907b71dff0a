"""Hourly amounts from a stream of accumulated ones.

State per column: the last step that was put out and its accumulated value, and steps that came
early. Steps are expected from ``first_step`` on without gaps; a step is held back until the one
before it has come, so out-of-order input gives the batch result. Late repeats are dropped. With ``patience_ms`` a
column that holds steps back and gets none for so long gives its missing step up: the next one is put out with an
undefined amount (as in the batch, where the step before is undefined), so what is held can't grow without end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..shipping import ship


def released(last: int, value: float, steps: np.ndarray, values: np.ndarray, first_step: int, give_up: bool = False) -> tuple[int, float, np.ndarray, np.ndarray, np.ndarray]:
    """Steps that follow on without a gap leave the held ones (sorted, distinct): last step and value, amounts put out, steps and values still held."""
    if give_up and len(steps) and steps[0] != last + 1:
        last, value = int(steps[0]) - 1, np.nan
    n = int(np.argmin(np.r_[steps == last + 1 + np.arange(len(steps)), False]))
    before = np.r_[0.0 if last < first_step else value, values[: max(0, n - 1)]][:n]
    amounts = values[:n] - before
    if n:
        last, value = int(steps[n - 1]), float(values[n - 1])
    return last, value, amounts, steps[n:], values[n:]


def _arrays(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Steps and values; rows without a step don't count."""
    steps, values = rows["step"].to_numpy(), rows["tot_prec"].to_numpy(np.float64)
    if steps.dtype.kind != "i":
        known = pd.notna(steps)
        steps, values = steps[known], values[known]
    return steps.astype(np.int64), values


def deaccumulate_stream(acc: DataFrame, key: str = "cell_id", *, first_step: int = 0, patience_ms: int | None = None) -> DataFrame:
    """Streaming (key, step, tot_prec) to (key, step, total_precip_mm)."""

    def advance(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, value, steps, values = state.get if state.exists else (first_step - 1, 0.0, [], [])
        late = state.hasTimedOut
        # arrays, not frames: there is a call for each column and batch
        seen = [(np.array(steps, np.int64), np.array(values, np.float64)), *([] if late else map(_arrays, batches))]
        steps, values = (np.concatenate(x) for x in zip(*seen, strict=True))
        steps, at = np.unique(steps, return_index=True)  # of repeats the first
        new = np.searchsorted(steps, last, side="right")
        steps, values = steps[new:], values[at[new:]]
        begin = last + 1 if not late or not len(steps) else int(steps[0])
        last, value, amounts, steps, values = released(last, value, steps, values, first_step, late)
        state.update((last, value, steps.tolist(), values.tolist()))
        if patience_ms is not None and len(steps):
            state.setTimeoutDuration(patience_ms)
        if len(amounts):
            yield pd.DataFrame({key: np.repeat(np.array([group[0]]), len(amounts)), "step": np.arange(begin, begin + len(amounts), dtype=np.int32), "total_precip_mm": amounts})

    ship(acc.sparkSession)
    kind = acc.schema[key].dataType.simpleString()
    return acc.groupBy(key).applyInPandasWithState(
        advance, f"{key} {kind}, step int, total_precip_mm double", "last int, value double, steps array<int>, vals array<double>", "append",
        GroupStateTimeout.NoTimeout if patience_ms is None else GroupStateTimeout.ProcessingTimeTimeout,
    )


def replay(acc: DataFrame, folder: str, parts: int = 3) -> DataFrame:
    """Put a table through the stream in ``parts`` files of mixed steps and give the result (for tests and queries)."""
    spark = acc.sparkSession
    acc.repartition(parts, "step").write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(acc.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    q = deaccumulate_stream(stream).writeStream.format("parquet").option("checkpointLocation", f"{folder}/state").start(f"{folder}/out")
    q.processAllAvailable()
    q.stop()
    return spark.read.parquet(f"{folder}/out")
