"""Debounced triggers as keyed stream state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


SETTINGS = {
    PROVIDER: ROCKSDB,
    # A restart loads the files of the store; it does not repeat every change since a snapshot.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "false",
    # All stores of an executor share one bound, however many partitions it holds.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # A join keeps one store per partition instead of four.
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


def use_keyed_state(spark: SparkSession) -> None:
    """State on disk with bounded memory, for streams that are started afterwards.

    Value state needs this store, and the state of a join would otherwise fill the heap.
    """
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)


BUCKETS = 1024  # groups of models that share one state value and one call


class Streak(StatefulProcessor):
    """One number per model: how many counted hits its open run has.

    A key is a bucket of models, whose rows of a batch are taken together: a call for each
    model would cost more than its rows. Models without an open run are not kept.
    """

    def __init__(self, by: str, ts: str, required: int):
        self.by, self.ts, self.required = by, ts, required

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", "models array<string>, n array<long>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        table = pd.concat(list(rows), ignore_index=True)
        code, models = pd.factorize(table[self.by], use_na_sentinel=False)
        time, _ = pd.factorize(table[self.ts], sort=True)
        order = np.lexsort((np.where(time < 0, len(time), time), code))  # stable, no time last
        table, code = table.take(order), code[order]
        hit, stop = table["hit"].to_numpy(bool), table["stop"].to_numpy(bool)
        first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])  # of each model, in the order of its code
        last = np.r_[first[1:], len(code)] - 1
        held = dict(zip(*self.open.get(), strict=True)) if self.open.exists() else {}
        names = [None if pd.isna(m) else m for m in models]
        entering = np.array([held.get(m, 0) for m in names], np.int64)
        # Hits since the model's first row in the batch, and those up to the last stop before
        # a row; the run that entered the batch has none. Both grow within a model alone.
        hits = np.cumsum(hit) - (np.cumsum(hit)[first] - hit[first])[code]
        lift = (np.arange(len(first)) * (len(code) + entering.max() + 1))[code]
        ended = np.maximum.accumulate(np.where(stop, hits, -entering[code]) + lift) - lift
        length = hits - ended
        held.update(zip(names, length[last].tolist(), strict=True))
        left = {m: n for m, n in held.items() if n}
        self.open.update((list(left), list(left.values())))
        place = np.where(hit, (length - 1) % self.required + 1, 0)
        yield pd.DataFrame({
            self.by: table[self.by].to_numpy(), self.ts: table[self.ts].to_numpy(),
            "streak": place.astype(np.int32), "fire": hit & (length % self.required == 0),
        })

    def close(self) -> None:
        pass


def debounce_stream(
    cycles: DataFrame,
    required: int = 2,
    by: str = "model_name",
    ts: str = "cycle_ts",
    triggered: str = "triggered",
    evaluated: str | None = None,
    allow: str | None = None,
) -> DataFrame:
    """(by, ts, streak, fire) for a stream of cycles; the rules are those of ``debounce``.

    State is one counter per model, held by buckets of models. Cycles of a micro-batch are taken in time order; they
    are expected to arrive in order across batches, as a monitor writes them.
    """
    use_keyed_state(cycles.sparkSession)
    hit = F.coalesce(F.col(triggered), F.lit(False))
    if allow:
        hit = hit & F.coalesce(F.col(allow), F.lit(False))
    counted = F.coalesce(F.col(evaluated), F.lit(False)) if evaluated else F.lit(True)
    bucket = F.pmod(F.xxhash64(F.col(by).cast("string")), F.lit(BUCKETS)).cast("int").alias("_bucket")
    marked = cycles.select(
        bucket, F.col(by).cast("string").alias(by), ts, (counted & hit).alias("hit"), (counted & ~hit).alias("stop")
    )
    kind = cycles.schema[ts].dataType.simpleString()
    return marked.groupBy("_bucket").transformWithStateInPandas(
        Streak(by, ts, max(1, required)),
        f"{by} string, {ts} {kind}, streak int, fire boolean",
        "Append",
        "None",
    )
