"""What the registry holds of what is wanted: lookups, counts and gates by source, release and projection."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import lookup_join


def url_ids(links: DataFrame, frontier: DataFrame) -> DataFrame:
    """links (with url) and url_id of the frontier (url, url_id; a row per url); links to unknown addresses are left out."""
    return lookup_join(links, frontier.select("url", "url_id"), ["url"], how="inner")


def export_links(links: DataFrame, artifacts: DataFrame) -> DataFrame:
    """links (with url) and target, the last of the artifacts (artifact_id, url) of that address; null where there is none."""
    last = artifacts.where("url is not null").groupBy("url").agg(F.max("artifact_id").alias("target"))
    return lookup_join(links, last, ["url"])


def model_declarations(models: DataFrame, declarations: DataFrame, key: str, row: str, name: str) -> DataFrame:
    """key, declared, names: how often and under how many names each of models is declared; models without a declaration are left out."""
    wanted = models.where(F.col(key).isNotNull()).select(key, F.lit(True).alias("wanted_")).distinct()
    return lookup_join(declarations, wanted, [key], how="inner").groupBy(key).agg(F.count_distinct(row).alias("declared"), F.count_distinct(name).alias("names"))


def seed_resources(resources: DataFrame, records: DataFrame, key: str) -> DataFrame:
    """The distinct keys of resources whose record is there."""
    return resources.select(key).distinct().join(records.select(key).distinct(), key, "left_semi")


def eligible(known: DataFrame, failures: DataFrame, key: str, most: int) -> DataFrame:
    """key, failures: the known keys that failed less than most times; failures are counted first, so a hot key is one row."""
    failed = failures.groupBy(key).agg(F.count("*").alias("failures"))
    return known.select(key).join(failed, key, "left").fillna(0, ["failures"]).where(F.col("failures") < most)


def covered(wanted: DataFrame, index: DataFrame, name: str = "name") -> DataFrame:
    """wanted with found: whether its name is in the index; null names are not."""
    names = index.where(F.col(name).isNotNull()).select(name, F.lit(True).alias("found")).distinct()
    return lookup_join(wanted, names, [name]).withColumn("found", F.coalesce("found", F.lit(False)))


def coverage_metrics(artifacts: DataFrame, source: str, active: Column, revision: str) -> DataFrame:
    """source, artifacts, active, revisions by source; null is a source of its own."""
    return artifacts.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("artifacts"), F.count_if(active).alias("active"), F.count_distinct(revision).alias("revisions"))


def relation_counts(evidence: DataFrame, kind: str) -> DataFrame:
    return evidence.groupBy(F.col(kind).alias("evidence_type")).agg(F.count("*").alias("n"))


def projection_stats(documents: DataFrame, counts: Mapping[str, Column]) -> DataFrame:
    """One row: documents, sources and the documents that meet each named condition."""
    return documents.agg(F.count("*").alias("documents"), F.count_distinct("source").alias("sources"), *[F.count_if(c).alias(n) for n, c in counts.items()])


def lake_status(records: DataFrame, release: str, shard: str) -> DataFrame:
    """release, shards, rows of each release, and of 'all' together; rows without a release count only there."""
    known = records.select(F.col(release).alias("release"), F.col(shard).alias("shard"))
    each = known.where("release is not null").groupBy("release").agg(F.count_distinct("shard").alias("shards"), F.count("*").alias("rows"))
    return each.unionByName(known.agg(F.count_distinct("shard").alias("shards"), F.count("*").alias("rows")).withColumn("release", F.lit("all")))


def readiness(configured: DataFrame, checkpoints: DataFrame, artifacts: DataFrame, claims: DataFrame) -> DataFrame:
    """source, artifacts, candidates, claims and six gates: configured, enabled, observed, complete, has_artifacts, has_claims; ready if all hold.

    configured has source and enabled, checkpoints source and complete (a row per source each), artifacts source
    and artifact_id, claims artifact_id. A gate about which nothing is known is false.
    """
    claimed = claims.groupBy("artifact_id").agg(F.count("*").alias("claims"))
    sums = lookup_join(artifacts.select("source", "artifact_id").distinct(), claimed, ["artifact_id"]).groupBy("source").agg(
        F.count("*").alias("artifacts"), F.count("claims").alias("candidates"), F.coalesce(F.sum("claims"), F.lit(0)).alias("claims")
    )
    named = configured.select("source", F.lit(True).alias("configured"), "enabled")
    seen = checkpoints.select("source", F.lit(True).alias("observed"), "complete")
    rows = named.join(seen, "source", "full_outer").join(sums, "source", "full_outer").fillna(0, ["artifacts", "candidates", "claims"]).fillna(False, ["configured", "enabled", "observed", "complete"])
    gates = {"has_artifacts": F.col("artifacts") > 0, "has_claims": F.col("claims") > 0}
    every = ["configured", "enabled", "observed", "complete", *gates]
    return rows.withColumns(gates).withColumn("ready", reduce(Column.__and__, [F.col(g) for g in every]))


def releases_of_model(releases: DataFrame, release: str, model: str, seen: str) -> DataFrame:
    """release_id, models, first_seen."""
    return releases.groupBy(F.col(release).alias("release_id")).agg(F.count_distinct(model).alias("models"), F.min(seen).alias("first_seen"))


def union_of(*sides: DataFrame) -> DataFrame:
    """The distinct rows of all sides; each side is reduced before they meet."""
    return reduce(DataFrame.unionByName, [s.distinct() for s in sides]).distinct()


def intersection_of(one: DataFrame, other: DataFrame) -> DataFrame:
    """The distinct rows in both, nulls being equal."""
    return one.intersect(other)


def difference_of(one: DataFrame, other: DataFrame) -> DataFrame:
    """The distinct rows of one that other lacks, nulls being equal."""
    return one.subtract(other)
