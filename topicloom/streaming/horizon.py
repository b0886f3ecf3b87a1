"""STR-02: deduplication within an event-time horizon, whatever the micro-batches.

The rule: walking a key's rows in event-time order, a row survives if no surviving
row of the key lies less than ``horizon`` before it.  (So a key that keeps coming
back is let through once a horizon, as the three-day training window sees it.)

``dropDuplicatesWithinWatermark`` keeps whichever row of a key arrives first, so its
result changes with the way files fall into batches.  Here a keyed state holds the
rows of a key until the watermark has passed them -- then no earlier row can come any
more -- and decides them in event-time order, on event-time timers.  The state of a
key goes when the watermark is a horizon past its last survivor.

A row at or before the watermark when it arrives is late: Spark drops it and counts
it.  Rows that the watermark has not passed when the input ends stay undecided and
come out of the next run on the same checkpoint.  Rows of a key at the same instant
are taken in the order of their values.

Each call to a keyed state costs a round trip to the Python worker, so keys share states:
a state holds a hash bucket of keys, its pending rows in one compressed block a
micro-batch.  The number of calls depends on the buckets and the micro-batches, not
on the keys or the rows; a checkpoint belongs to one number of buckets.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from itertools import groupby
from operator import itemgetter

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Keyed state with timers lives in this store (a setting of the query, not of the cluster).
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

#: States a stream has; the keys are dealt over them by hash.
BUCKETS = 1024

_ROWS = pa.schema([("key", pa.string()), ("at", pa.int64()), ("row", pa.string())])
_LAST = pa.schema([("key", pa.string()), ("at", pa.int64())])

_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the start of a query, put back afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def survivors(rows: list[tuple[int, str]], last: int | None, horizon: int) -> tuple[list[tuple[int, str]], int | None]:
    """Rows (time, value) in order that survive after a survivor at ``last``, and the new last."""
    out = []
    for at, row in rows:
        if last is None or at - last >= horizon:
            out.append((at, row))
            last = at
    return out, last


def pack(columns: list, schema: pa.Schema) -> bytes:
    """Columns as one compressed block."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema))
    return sink.getvalue().to_pybytes()


def unpack(block: bytes) -> list[tuple]:
    """The rows of a block."""
    with pa.ipc.open_stream(block) as r:
        return [row for batch in r for row in zip(*(c.to_pylist() for c in batch.columns))]


def decide(rows: list[tuple[str, int, str]], last: dict[str, int], horizon: int) -> list[str]:
    """Values of the rows (key, time, value) that survive; ``last`` moves on with its keys."""
    out = []
    for key, of_key in groupby(sorted(rows), itemgetter(0)):
        kept, at = survivors([r[1:] for r in of_key], last.get(key), horizon)
        out += [row for _, row in kept]
        last[key] = at
    return out


class HorizonProcessor(StatefulProcessor):
    """The state of one bucket of keys.  Times are microseconds since the epoch, timers milliseconds."""

    def __init__(self, horizon_us: int):
        self.horizon = horizon_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        block = T.StructType().add("block", T.BinaryType())
        self.handle = handle
        self.pending = handle.getListState("pending", block)
        self.last = handle.getValueState("last", block)
        self.armed = handle.getValueState("armed", T.StructType().add("ms", T.LongType()))

    def _arm(self, ms: int) -> None:
        """One timer a bucket: the earliest that is wanted."""
        old = self.armed.get()[0] if self.armed.exists() else None
        if old is not None and old <= ms:
            return
        if old is not None:
            self.handle.deleteTimer(old)
        self.handle.registerTimer(ms)
        self.armed.update((ms,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # Columns come by position: bucket, key, event time, microseconds, row.
        first = None
        for pdf in rows:
            if len(pdf):
                self.pending.appendValue((pack([pdf.iloc[:, 1], pdf.iloc[:, 3], pdf.iloc[:, 4]], _ROWS),))
                low = int(pdf.iloc[:, 3].min())
                first = low if first is None else min(first, low)
        if first is not None:
            self._arm(first // 1000 + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        rows = [row for (block,) in self.pending.get() for row in unpack(block)]
        last = dict(unpack(self.last.get()[0])) if self.last.exists() else {}
        rest = [r for r in rows if r[1] >= passed]
        out = decide([r for r in rows if r[1] < passed], last, self.horizon)
        # A survivor a horizon behind the watermark bears on no row that may still come.
        waiting = {r[0] for r in rest}
        last = {k: at for k, at in last.items() if k in waiting or at + self.horizon > passed}
        self.armed.clear()
        if rest:
            self.pending.put([(pack(list(zip(*rest)), _ROWS),)])
            self._arm(min(r[1] for r in rest) // 1000 + 1)
        else:
            self.pending.clear()
        if last:
            self.last.update((pack([list(last), list(last.values())], _LAST),))
            if not rest:
                self._arm((min(last.values()) + self.horizon) // 1000 + 1)
        else:
            self.last.clear()
        if out:
            yield pd.DataFrame({"_row": out})


def dedup_horizon(df: DataFrame, keys: list[str], ts_col: str, horizon: str = "3 days", lateness: str = "3 days") -> DataFrame:
    """The surviving rows of a stream, with its columns.  Null keys are a key; rows
    without an event time can't be placed and go.  Run it with ``STATE_STORE``."""
    spark = df.sparkSession
    length = spark.range(1).select(F.expr(f"unix_micros(timestamp_micros(0) + interval {horizon})")).first()[0]
    row = F.to_json(F.struct(*df.columns), _JSON)
    key = F.to_json(F.struct(*keys), _JSON)
    rows = df.where(F.col(ts_col).isNotNull()).select(key.alias("_key"), F.col(ts_col).alias("_ts"), F.unix_micros(ts_col).alias("_at"), row.alias("_row"))
    narrow = rows.select(F.pmod(F.xxhash64("_key"), F.lit(BUCKETS)).cast("int").alias("_bucket"), "*")
    kept = (
        narrow.withWatermark("_ts", lateness)
        .groupBy("_bucket")
        .transformWithStateInPandas(HorizonProcessor(length), outputStructType="_row string", outputMode="Append", timeMode="EventTime")
    )
    return kept.select(F.from_json("_row", df.schema, _JSON).alias("_r")).select("_r.*")
