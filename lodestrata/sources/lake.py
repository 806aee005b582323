"""The sealed lake: shards of raw records land as Parquet, a release is readable once all its shards are there."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.checks import Violation, assert_empty

SCHEMA = "source_record_id string, operation string, payload_json string, content_sha256 string, ingested_at timestamp, manifest_index long, diff_index long, operation_index long, from_release string, to_release string"


def _folder(root: str, source: str, dataset: str, release: str) -> str:
    return f"{root}/{source}/{dataset}/{release}"


def _write(path: str, value: dict) -> None:
    """Whole or not at all: a rename ends the write."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    draft = f"{path}.{uuid.uuid4().hex}"
    with open(draft, "w") as out:
        json.dump(value, out, sort_keys=True)
        out.flush()
        os.fsync(out.fileno())
    os.replace(draft, path)


def _read(path: str) -> dict | None:
    try:
        with open(path) as f:
            return json.load(f)
    except FileNotFoundError:
        return None


def with_hash(records: DataFrame) -> DataFrame:
    """records with content_sha256 of payload_json."""
    return records.withColumn("content_sha256", F.sha2("payload_json", 256))


def land(records: DataFrame, root: str, source: str, dataset: str, release: str, shard: str, control: str, expected_rows: int | None = None) -> dict:
    """Lands a shard (columns of SCHEMA) and gives its receipt. The same control again changes nothing; another one for the same shard is an error."""
    folder = _folder(root, source, dataset, release)
    receipt = _read(f"{folder}/shards/{shard}.json")
    if receipt:
        if receipt["control"] != control:
            raise Violation(f"shard {shard} has landed under another control")
        return receipt
    bad = records.where("source_record_id is null or operation is null or operation not in ('upsert', 'delete') or payload_json is null or content_sha256 <> sha2(payload_json, 256)")
    assert_empty(bad.select("source_record_id", "operation"), "invalid lake record")
    path = f"{folder}/data/{shard}-{uuid.uuid4().hex}.parquet"
    records.write.option("compression", "zstd").parquet(path)
    rows = records.sparkSession.read.parquet(path).count()
    if expected_rows is not None and rows != expected_rows:
        shutil.rmtree(path, ignore_errors=True)
        raise Violation(f"shard {shard} has {rows} rows, not {expected_rows}")
    receipt = {"source": source, "dataset": dataset, "release": release, "shard": shard, "control": control, "path": path, "rows": rows}
    _write(f"{folder}/shards/{shard}.json", receipt)
    return receipt


def seal(root: str, source: str, dataset: str, release: str, expected: set[str]) -> dict:
    """Seals a release that has exactly the expected shards."""
    folder = _folder(root, source, dataset, release)
    names = sorted(os.listdir(f"{folder}/shards")) if os.path.isdir(f"{folder}/shards") else []
    landed = {n[:-5] for n in names if n.endswith(".json")}
    if landed != set(expected):
        raise Violation(f"missing shards {sorted(set(expected) - landed)}, unexpected {sorted(landed - set(expected))}")
    receipts = [_read(f"{folder}/shards/{s}.json") for s in sorted(landed)]
    done = {"shards": receipts, "rows": sum(r["rows"] for r in receipts), "digest": hashlib.sha256(json.dumps(receipts, sort_keys=True).encode()).hexdigest()}
    _write(f"{folder}/SEAL.json", done)
    return done


def scan_release(spark: SparkSession, root: str, source: str, dataset: str, release: str, columns: list[str] | None = None) -> DataFrame:
    """A sealed release; its order is in its columns. An unsealed one can't be read."""
    done = _read(f"{_folder(root, source, dataset, release)}/SEAL.json")
    if done is None:
        raise Violation(f"release {release} is not sealed")
    df = spark.read.schema(SCHEMA).parquet(*[r["path"] for r in done["shards"]])
    return df.select(*columns) if columns else df


def scan_shard(spark: SparkSession, root: str, source: str, dataset: str, release: str, shard: str) -> DataFrame:
    """A landed shard before its release is sealed."""
    receipt = _read(f"{_folder(root, source, dataset, release)}/shards/{shard}.json")
    if receipt is None:
        raise Violation(f"shard {shard} has not landed")
    return spark.read.schema(SCHEMA).parquet(receipt["path"])


def releases(root: str) -> list[dict]:
    """source, dataset, release, shards, rows of all sealed releases, sorted."""
    found = []
    for base, _, files in os.walk(root):
        if "SEAL.json" in files:
            source, dataset, release = base.removeprefix(root).strip("/").split("/")
            done = _read(f"{base}/SEAL.json")
            found.append({"source": source, "dataset": dataset, "release": release, "shards": len(done["shards"]), "rows": done["rows"]})
    return sorted(found, key=lambda r: (r["source"], r["dataset"], r["release"]))


def ready(found: list[dict], datasets: set[str]) -> list[str]:
    """Releases sealed in all datasets, sorted; the newest is the last."""
    have: dict[str, set[str]] = {}
    for r in found:
        have.setdefault(r["release"], set()).add(r["dataset"])
    return sorted(r for r, d in have.items() if datasets <= d)


def plan(landed: DataFrame, controls: DataFrame, order: list[str], budget: int) -> DataFrame:
    """The next shards to load: controls (source, dataset, release, shard) not among the landed ones, in order, at most budget; a repeated control is an error."""
    keys = ["source", "dataset", "release", "shard"]
    assert_empty(controls.groupBy(*keys).count().where("count > 1"), "repeated control")
    return controls.join(landed.select(*keys), keys, "left_anti").orderBy(*order).limit(budget)


def projection_plan(seals: DataFrame, release: str, datasets: set[str]) -> dict:
    """mode, base_release, transitions and inputs of a projection of a release; whatever is ambiguous is an error.

    seals has dataset, release, mode, digest and, for diffs, diff_index, from_release, to_release: a row per
    dataset and transition, as many as a release has diffs. All datasets must be sealed in one mode and
    agree in their transitions, which must lead from one release to the next up to the planned one.
    """
    rows = [r.asDict() for r in seals.where((F.col("release") == release) & F.col("dataset").isin(*sorted(datasets))).distinct().collect()]
    missing = datasets - {r["dataset"] for r in rows}
    modes, digests = {r["mode"] for r in rows}, {(r["dataset"], r["digest"]) for r in rows}
    if missing or len(modes) != 1 or len(digests) != len(datasets):
        raise Violation(f"release {release}: missing {sorted(missing)}, modes {sorted(modes)}, {len(digests)} seals")
    mode = modes.pop()
    steps: dict[str, list] = {d: sorted((r["diff_index"], r["from_release"], r["to_release"]) for r in rows if r["dataset"] == d) for d in datasets} if mode == "diff" else {}
    chain = next(iter(steps.values()), [])
    if any(s != chain for s in steps.values()):
        raise Violation(f"release {release}: the datasets disagree in their transitions")
    if chain and (any(a[2] != b[1] for a, b in zip(chain, chain[1:])) or chain[-1][2] != release or len({n for n, _, _ in chain}) != len(chain)):
        raise Violation(f"release {release}: its transitions do not lead to it")
    return {"release": release, "mode": mode, "base_release": chain[0][1] if chain else None, "transitions": chain, "inputs": sorted(digests)}


def projection(df: DataFrame, root: str, name: str, inputs: dict) -> str:
    """Writes a projection under the digest of its inputs, sealed when complete; the same inputs reopen it."""
    digest = hashlib.sha256(json.dumps([name, inputs], sort_keys=True).encode()).hexdigest()
    folder = f"{root}/{name}/{digest}"
    if _read(f"{folder}/SEAL.json") is None:
        path = f"{folder}/data-{uuid.uuid4().hex}.parquet"
        df.write.option("compression", "zstd").parquet(path)
        _write(f"{folder}/SEAL.json", {"inputs": inputs, "path": path, "rows": df.sparkSession.read.parquet(path).count()})
    return folder


def scan_projection(spark: SparkSession, folder: str, columns: list[str] | None = None) -> DataFrame:
    done = _read(f"{folder}/SEAL.json")
    if done is None:
        raise Violation("the projection is not sealed")
    df = spark.read.parquet(done["path"])
    if df.count() != done["rows"]:
        raise Violation("the projection differs from its seal")
    return df.select(*columns) if columns else df


def export_jsonl(df: DataFrame, path: str, order: list[str]) -> None:
    """Sorted JSON lines in order of the part files' names; an existing export is never overwritten."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("error").option("ignoreNullFields", "false").json(path)
