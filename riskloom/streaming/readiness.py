"""Readiness on a live stream: emit a key once all three sources have written."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from riskloom.operators.latest import SOURCES

OUTPUT = "sk_id_curr string, source string, ts timestamp"


class _Coordinator(StatefulProcessor):
    """Per key: the sources seen, and whether the key was announced. Every write
    renews the lifetime of both; when it runs out the set starts empty again."""

    def __init__(self, lifetime_ms: int, every_write: bool) -> None:
        self.lifetime_ms = lifetime_ms
        self.every_write = every_write

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "sources string, announced boolean", self.lifetime_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        known = self.seen.get() if self.seen.exists() else None
        sources = set(known[0].split(",")) if known and known[0] else set()
        announced = bool(known[1]) if known else False
        out = []
        for batch in rows:
            for source, ts in zip(batch["source"], batch["ts"]):
                sources.add(source)
                if len(sources) == len(SOURCES) and (self.every_write or not announced):
                    out.append((key[0], source, ts))
                    announced = True
        self.seen.update((",".join(sorted(sources)), announced))
        yield pd.DataFrame(out, columns=["sk_id_curr", "source", "ts"])

    def close(self) -> None:
        pass


def _first_per_source(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Keep a key's first write per source in each Arrow batch before the shuffle, so
    a hot key sends a handful of rows instead of all of its own."""
    for batch in batches:
        yield batch.sort_values("ts").drop_duplicates(["sk_id_curr", "source"])


def ready_events(arrivals: DataFrame, ttl_seconds: int, every_write: bool = False) -> DataFrame:
    """Streaming twin of ``feature_ready`` on processing time (needs the RocksDB
    state store)."""
    rows = arrivals.select("sk_id_curr", "source", "ts").where(arrivals["source"].isin(SOURCES))
    if not every_write:
        rows = rows.mapInPandas(_first_per_source, rows.schema)
    return rows.groupBy("sk_id_curr").transformWithStateInPandas(
        statefulProcessor=_Coordinator(ttl_seconds * 1000, every_write),
        outputStructType=OUTPUT,
        outputMode="Append",
        timeMode="ProcessingTime",
    )


# Session settings of the job. A processing-time state operator asks for another empty
# micro-batch after every one, so a run over available data would never end; expired
# state is dropped when its key is next read, so empty batches are not needed.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
