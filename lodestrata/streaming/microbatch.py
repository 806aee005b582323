"""Incremental operation: micro-batches with checkpoints, leases, windows, and a day's pipeline."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.checks import Violation
from ..operators.store import read_head, sink_commit

LEASE = dt.timedelta(hours=6)


def sync_microbatch(root: str, source: str, fetch: Callable[[dict], tuple[DataFrame, dict, bool]], ingest: Callable[[DataFrame, dict[str, DataFrame]], dict[str, DataFrame]], spark: SparkSession, signature: str, most_pages: int = 1) -> int:
    """Fetches pages by an opaque state and commits each with its checkpoint at once; gives the pages read.

    A state of another signature is not gone on from, and a page that neither ends nor moves the state is an error.
    """
    pages = 0
    while pages < most_pages:
        head = read_head(root)
        tables = {n: spark.read.parquet(t["path"]) for n, t in head["tables"].items()} if head else {}
        saved = tables["checkpoints"].where(F.col("source") == source).first() if "checkpoints" in tables else None
        if saved and saved["signature"] != signature:
            raise Violation(f"the checkpoint of {source} belongs to another configuration")
        state = json.loads(saved["state"]) if saved else {}
        rows, next_state, complete = fetch(state)
        if not complete and next_state == state:
            raise Violation(f"a page of {source} does not advance")
        made = ingest(rows, {n: t for n, t in tables.items() if n != "checkpoints"})
        own = spark.createDataFrame([(source, json.dumps(next_state, sort_keys=True), signature, complete)], "source string, state string, signature string, complete boolean")
        others = tables["checkpoints"].where(F.col("source") != source) if "checkpoints" in tables else None
        made["checkpoints"] = others.unionByName(own) if others is not None else own
        sink_commit(made, root)
        pages += 1
        if complete:
            break
    return pages


def start_run(runs: DataFrame, source: str, now: dt.datetime) -> DataFrame:
    """runs with a new running row for source: an unexpired running one is an error, an expired one is abandoned."""
    mine = (F.col("source") == source) & (F.col("status") == "running")
    stale = F.col("heartbeat_at") < F.lit(now - LEASE)
    if runs.where(mine & ~stale).limit(1).count():
        raise Violation(f"{source} is running")
    number = (runs.agg(F.max("id")).first()[0] or 0) + 1
    kept = runs.withColumn("status", F.when(mine & stale, "abandoned").otherwise(F.col("status")))
    return kept.unionByName(runs.sparkSession.createDataFrame([(number, source, "running", now, now)], "id long, source string, status string, started_at timestamp, heartbeat_at timestamp"))


def windows(first: dt.date, last: dt.date, days: int) -> list[tuple[dt.date, dt.date]]:
    """Inclusive windows from first to last."""
    out = []
    while first <= last:
        end = min(last, first + dt.timedelta(days=days - 1))
        out.append((first, end))
        first = end + dt.timedelta(days=1)
    return out


def backfill(done: set[tuple[dt.date, dt.date]], frozen: list[tuple[dt.date, dt.date]], run: Callable[[dt.date, dt.date], None]) -> set[tuple[dt.date, dt.date]]:
    """Runs the windows not done yet; all done is no work."""
    for window in frozen:
        if window not in done:
            run(*window)
            done = done | {window}
    return done


def bulk_load_and_seal(planned: Iterable[str], load: Callable[[str], None], expected: set[str], landed: Callable[[], set[str]], seal: Callable[[], None]) -> dict[str, str]:
    """Loads shards, each failure by itself, and seals when nothing failed and all are there; gives the failures."""
    failed = {}
    for shard in planned:
        try:
            load(shard)
        except Exception as error:  # noqa: BLE001 - one shard must not stop the others
            failed[shard] = str(error)
    if not failed and landed() == expected:
        seal()
    return failed


def daily_pipeline(steps: list[tuple[str, Callable[[], object]]]) -> dict[str, str]:
    """Runs the steps in order, each failure by itself; gives ok or the error of each."""
    out = {}
    for name, step in steps:
        try:
            step()
            out[name] = "ok"
        except Exception as error:  # noqa: BLE001
            out[name] = f"{type(error).__name__}: {error}"
    return out


def late_data(known: DataFrame, batch: DataFrame, key: str, content: str) -> DataFrame:
    """Rows of an overlapping batch whose content is new for their key."""
    return batch.join(known.select(key, content), [key, content], "left_anti").dropDuplicates([key, content])


def stream_state(stream: DataFrame, path: str, checkpoint: str, key: str, apply: Callable[[DataFrame, DataFrame | None], DataFrame]) -> object:
    """Starts a query that keeps a state table under path current: each micro-batch writes the state after it under the batch's number, so a repeated batch replaces its own."""

    def step(batch: DataFrame, number: int) -> None:
        before = batch.sparkSession.read.parquet(f"{path}/{number - 1}") if number else None
        apply(batch, before).write.mode("overwrite").parquet(f"{path}/{number}")

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
