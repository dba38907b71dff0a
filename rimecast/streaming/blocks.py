"""Steps of whole blocks of cells as a stream: hourly amounts from accumulated ones.

The state of a block is the last step that was put out with its accumulated values, and a map of the steps that came early; both lie in
RocksDB, so what a task holds in memory is one block. Steps are expected from ``first_step`` on without gaps: a step is held back until
the one before it has come, so input in any order, and a query that goes on from its checkpoint, give the batch's result. Repeats of a step
are dropped. With ``patience_ms`` a timer gives a missing step up: the next one is put out with undefined amounts, as in the batch, where
the step before is undefined. One call works on a block of cells, none on a single cell.

A null value is undefined (NaN); a block whose number of cells changes from step to step is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..shipping import ship

ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocks_db(spark: SparkSession) -> None:
    """The state of new queries of this session lies in RocksDB, as ``transformWithState`` needs it."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS_DB)


class BlockSteps(StatefulProcessor):
    """Releases a block's steps in order, each less the one before."""

    def __init__(self, keys: list[str], first_step: int, patience_ms: int | None):
        self.keys, self.first_step, self.patience_ms = keys, first_step, patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "step int, vals array<double>")
        self.held = handle.getMapState("held", "step int", "vals array<double>")

    def close(self) -> None:
        pass

    def _released(self, key: tuple, give_up: bool) -> Iterator[pd.DataFrame]:
        known = self.last.get() if self.last.exists() else None
        step, before = (self.first_step - 1, None) if known is None else (known[0], np.array(known[1], np.float64))
        if give_up:
            step = min(k[0] for k in self.held.keys()) - 1
            before = np.full(1, np.nan)
        out = []
        while self.held.containsKey((step + 1,)):
            values = np.array(self.held.getValue((step + 1,))[0], np.float64)
            if before is not None and len(before) not in (1, len(values)):
                raise ValueError(f"{dict(zip(self.keys, key, strict=True))} has {len(values)} cells at step {step + 1}, {len(before)} before")
            out.append((step + 1, values if before is None else values - before))
            self.held.removeKey((step + 1,))
            step, before = step + 1, values
        if out:
            self.last.update((step, before.tolist()))
            rows = {k: [v] * len(out) for k, v in zip(self.keys, key, strict=True)}
            yield pd.DataFrame(rows | {"step": np.array([s for s, _ in out], np.int32), "amounts": [a.tolist() for _, a in out]})

    def _wait(self, timers) -> None:
        """One timer while steps are held back, none otherwise."""
        if self.patience_ms is None:
            return
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        if any(True for _ in self.held.keys()):
            self.handle.registerTimer(timers.getCurrentProcessingTimeInMs() + self.patience_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last = self.last.get()[0] if self.last.exists() else self.first_step - 1
        for batch in rows:
            for step, values in zip(batch["step"], batch["vals"], strict=True):
                if step > last and not self.held.containsKey((int(step),)):
                    self.held.updateValue((int(step),), ([np.nan if v is None else float(v) for v in values],))
        yield from self._released(key, False)
        self._wait(timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if any(True for _ in self.held.keys()):
            yield from self._released(key, True)
        self._wait(timerValues)


def deaccumulate_blocks(blocks: DataFrame, keys: list[str], *, values: str = "vals", first_step: int = 0, patience_ms: int | None = None) -> DataFrame:
    """Streaming (keys, step, values) to (keys, step, amounts), arrays of one number per cell of the block."""
    ship(blocks.sparkSession)
    use_rocks_db(blocks.sparkSession)
    kinds = ", ".join(f"{k} {blocks.schema[k].dataType.simpleString()}" for k in keys)
    rows = blocks.selectExpr(*keys, "cast(step as int) step", f"cast({values} as array<double>) vals")
    return rows.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=BlockSteps(keys, first_step, patience_ms), outputStructType=f"{kinds}, step int, amounts array<double>",
        outputMode="Append", timeMode="None" if patience_ms is None else "ProcessingTime",
    )


def replay_blocks(blocks: DataFrame, keys: list[str], folder: str, parts: int = 3, stops: int = 1) -> DataFrame:
    """Put a table of blocks through the stream in ``parts`` files of mixed steps, ended and begun anew ``stops`` times."""
    spark = blocks.sparkSession
    blocks.repartition(parts, "step").write.parquet(f"{folder}/in")
    for k in range(stops + 1):
        stream = spark.readStream.schema(blocks.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        q = deaccumulate_blocks(stream, keys).writeStream.format("parquet").option("checkpointLocation", f"{folder}/state")
        q = q.trigger(availableNow=True).start(f"{folder}/out") if k == stops else q.start(f"{folder}/out")
        if k < stops:
            while not q.recentProgress and q.isActive:  # at least one file is done, then it is ended wherever it is
                q.awaitTermination(0.2)
            q.stop()
        else:
            q.awaitTermination()
    return spark.read.schema(_result_schema(blocks, keys)).parquet(f"{folder}/out")


def _result_schema(blocks: DataFrame, keys: list[str]) -> str:
    return ", ".join(f"{k} {blocks.schema[k].dataType.simpleString()}" for k in keys) + ", step int, amounts array<double>"
