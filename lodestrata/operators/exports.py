"""What leaves the registry: public tables, seeds, and both under one commit."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .checks import Violation, assert_empty, duplicates

#: Columns that hold texts of others as they came: never public.
PRIVATE = frozenset(("text", "raw_text", "full_text", "raw_json", "raw_payload_json", "payload_json", "html", "abstract"))


def links_sorted(links: Column) -> Column:
    """The distinct links of an array of structs (fields in alphabetic order) as JSON, sorted by it; null is the empty array."""
    return F.array_sort(F.array_distinct(F.coalesce(F.transform(links, lambda x: F.to_json(x, {"ignoreNullFields": "false"})), F.array().cast("array<string>"))))


def public_projection(tables: Mapping[str, DataFrame], columns: Mapping[str, list[str]]) -> dict[str, DataFrame]:
    """The listed columns of the listed tables, in the listed order. A table or column that is missing, or private, is an error."""
    missing = sorted(set(columns) - set(tables))
    if missing:
        raise Violation(f"no tables {missing}")
    for name, wanted in columns.items():
        private, unknown = sorted(PRIVATE & set(wanted)), sorted(set(wanted) - set(tables[name].columns))
        if private or unknown:
            raise Violation(f"{name}: private columns {private}, unknown columns {unknown}")
    return {name: tables[name].select(*wanted) for name, wanted in columns.items()}


def _put(spark: SparkSession, path: str, content: str) -> None:
    """A small file beside a written table, on whatever file system the path names; an existing one is an error."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, False)
    try:
        out.write(bytearray(content.encode("utf-8")))
    finally:
        out.close()


def file_digests(spark: SparkSession, path: str, pattern: str = "part-*") -> list[tuple[str, int, str]]:
    """(name, bytes, sha256) of the part files under path, sorted; hashed by the executors."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "length", F.sha2("content", 256).alias("sha256"))
    return sorted(tuple(r) for r in named.collect())


def metadata_export(tables: Mapping[str, DataFrame], columns: Mapping[str, list[str]], sources: DataFrame, path: str, title: str) -> dict:
    """Writes the public tables, sources as sources.json, a card README.md and receipt.json under path, which must be new; gives the receipt."""
    made = public_projection(tables, columns)
    spark = sources.sparkSession
    receipt: dict = {"tables": {}}
    for name, df in sorted(made.items()):
        target = f"{path}/{name}.parquet"
        df.write.mode("error").option("compression", "zstd").parquet(target)
        receipt["tables"][name] = {"rows": spark.read.parquet(target).count(), "columns": columns[name], "files": file_digests(spark, target)}
    sources.coalesce(1).orderBy(*sources.columns[:1]).write.mode("error").option("ignoreNullFields", "false").json(f"{path}/sources.json")
    card = [f"# {title}", "", "| table | rows | columns |", "| - | - | - |", *[f"| {n} | {t['rows']} | {', '.join(t['columns'])} |" for n, t in receipt["tables"].items()], ""]
    _put(spark, f"{path}/README.md", "\n".join(card))
    receipt["digest"] = hashlib.sha256(json.dumps(receipt["tables"], sort_keys=True).encode()).hexdigest()
    _put(spark, f"{path}/receipt.json", json.dumps(receipt, sort_keys=True))
    return receipt


def seeds_of(artifacts: DataFrame, declarations: DataFrame, links: DataFrame) -> DataFrame:
    """A seed for each current active artifact that declares models: its models and the links of the record or scoped to a model it declares.

    artifacts: artifact_id, source, source_record_id, kind, canonical_url, title, active, current_revision_id.
    declarations: artifact_revision_id, local_id, name. links: artifact_revision_id, url, relation, model_local_ids.
    Declarations and links of other revisions are left out. Links are distinct and sorted by their JSON.
    """
    current = artifacts.where("active = 1 and current_revision_id is not null").withColumnRenamed("current_revision_id", "artifact_revision_id").drop("active")
    assert_empty(duplicates(current, ["artifact_revision_id"]), "revision of two artifacts")
    models = declarations.where("artifact_revision_id is not null").groupBy("artifact_revision_id").agg(
        F.array_sort(F.collect_set(F.struct("local_id", "name"))).alias("models")  # those of one record
    )
    own = links.groupBy("artifact_revision_id").agg(F.collect_set(F.struct("model_local_ids", "relation", "url")).alias("links"))
    joined = current.join(models, "artifact_revision_id").join(own, "artifact_revision_id", "left")
    known = F.transform("models", lambda m: m["local_id"])
    scoped = F.filter("links", lambda x: x["model_local_ids"].isNull() | (F.size(x["model_local_ids"]) == 0) | F.arrays_overlap(x["model_local_ids"], known))
    return joined.select("source", "source_record_id", "kind", "canonical_url", "title", "models", links_sorted(scoped).alias("links"))


def seed_export(seeds: DataFrame, path: str, sources: list[str] | None = None) -> dict:
    """Writes the seeds (of the given sources) as sorted JSON lines under path, which must be new; gives rows and the files' digests."""
    order = ["source", "source_record_id"]
    wanted = seeds if sources is None else seeds.where(F.col("source").isin(*sources))
    assert_empty(duplicates(wanted, order), "record with two seeds")
    wanted.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("error").option("ignoreNullFields", "false").json(path)
    spark = seeds.sparkSession
    files = file_digests(spark, path)
    return {"rows": spark.read.text(path).count(), "files": files, "sha256": hashlib.sha256("".join(f[2] for f in files).encode()).hexdigest()}


def dataset_bundle(head: Callable[[], str | None], steps: Mapping[str, Callable[[], dict]], spark: SparkSession, path: str) -> dict:
    """Runs the exports of one commit and writes bundle.json; refuses it if the commit that head names has moved meanwhile."""
    before = head()
    if before is None:
        raise Violation("nothing is committed")
    made = {name: step() for name, step in steps.items()}
    if head() != before:
        raise Violation("the registry has moved on during the export")
    bundle = {"commit": before, "parts": made}
    _put(spark, f"{path}/bundle.json", json.dumps(bundle, sort_keys=True))
    return bundle
