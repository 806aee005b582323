"""Relations between artifacts from URLs and shared identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .checks import contradictions, duplicates
from .skew import lookup_join


def current_artifacts(artifacts: DataFrame) -> DataFrame:
    """Active artifacts that have a current revision."""
    return artifacts.where("active = 1 and current_revision_id is not null")


def join_current_revision(artifacts: DataFrame, evidence: DataFrame) -> DataFrame:
    """Evidence of current revisions with its artifact; evidence of older revisions is left out. See revision_conflicts."""
    current = current_artifacts(artifacts).select(F.col("id").alias("artifact_id"), F.col("current_revision_id").alias("artifact_revision_id"))
    return evidence.join(current, "artifact_revision_id")


def revision_conflicts(artifacts: DataFrame) -> DataFrame:
    return duplicates(current_artifacts(artifacts), ["current_revision_id"])


def without_license(links: DataFrame) -> DataFrame:
    return links.where(F.lower("relation") != "license")


def join_discovery_evidence(discoveries: DataFrame, evidence: DataFrame) -> DataFrame:
    """Each discovery with evidence_id, the lowest of its evidence, and evidence_count; null and 0 where it has none, which is an error."""
    keys = ["artifact_revision_id", "url_id", "relation", "locator"]
    grouped = evidence.withColumn("locator", F.coalesce("locator", F.lit(""))).groupBy(*keys).agg(F.min("id").alias("evidence_id"), F.count("*").alias("evidence_count"))
    return discoveries.withColumn("locator", F.coalesce("locator", F.lit(""))).join(grouped, keys, "left").withColumn("evidence_count", F.coalesce("evidence_count", F.lit(0)))


def join_url_targets(mentions: DataFrame, targets: DataFrame) -> DataFrame:
    """mentions (artifact_id, url) with target_id: one row per artifact that owns the URL, canonical addresses before aliases, no self edges.

    targets has url, artifact_id and rank (0 for a canonical URL, 1 for an identifier's alias). A row per
    mention and owner is what is asked for; owners of one URL are few, mentions may be many.
    """
    best = targets.groupBy("url", "artifact_id").agg(F.min("rank").alias("rank")).select("url", F.col("artifact_id").alias("target_id"), "rank")
    return mentions.join(best, "url").where(F.col("artifact_id") != F.col("target_id"))


def join_identity_star(claims: DataFrame, key: list[str], artifact: str, confidence: Column, claim: Column) -> DataFrame:
    """key, source_id, target_id, confidence, claim: from the least artifact of a key to each other one.

    A star, not all pairs: n artifacts give n - 1 rows. Of several claims of an artifact the first by
    text counts. The confidence is the lower of the two ends.
    """
    single = claims.where(F.col(artifact).isNotNull()).groupBy(*key, F.col(artifact).alias("artifact")).agg(F.min(F.struct(claim.alias("claim"), confidence.alias("confidence"))).alias("c"))
    anchors = single.groupBy(*key).agg(F.min(F.struct("artifact", "c")).alias("a"), F.count("*").alias("n")).where("n > 1")
    ends = single.join(anchors.drop("n"), key).where(F.col("artifact") != F.col("a.artifact"))
    return ends.select(
        *key, F.col("a.artifact").alias("source_id"), F.col("artifact").alias("target_id"), F.least("a.c.confidence", "c.confidence").alias("confidence"), F.col("a.c.claim").alias("claim")
    )


def dedupe_relation(relations: DataFrame, key: str, content: list[str]) -> DataFrame:
    """Identical relations once; contradictory_relations has the rest."""
    return relations.select(key, *content).distinct()


def contradictory_relations(relations: DataFrame, key: str, content: list[str]) -> DataFrame:
    return contradictions(relations, [key], F.to_json(F.struct(*content), {"ignoreNullFields": "false"}))


def dedupe_first_seen(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by order."""
    columns = [c for c in df.columns if c not in key]
    first = df.groupBy(*key).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("r"))
    return first.select(*key, *[F.col(f"r.{c}").alias(c) for c in columns])


def page_by_ordinal(df: DataFrame, ordinal: str, key: str, start: int, most_rows: int, most_keys: int) -> DataFrame:
    """Rows from ordinal start on: at most most_rows of them, and only up to the row that brings the most_keys-th distinct key.

    The row limit comes first and bounds what the running count of keys sees.
    """
    page = df.where(F.col(ordinal) >= start).orderBy(ordinal).limit(most_rows)
    first = page.groupBy(key).agg(F.min(ordinal).alias("first"))
    stop = first.orderBy("first").offset(most_keys).limit(1).agg(F.min("first").alias("stop"))
    return page.join(F.broadcast(stop), F.col("stop").isNull() | (F.col(ordinal) < F.col("stop"))).drop("stop")


def join_ordinal_merge(documents: DataFrame, candidates: DataFrame, relations: DataFrame, ordinal: str) -> DataFrame:
    """documents that have a candidate or a repository relation, with both counts."""
    c = candidates.groupBy(ordinal).agg(F.count("*").alias("candidates"))
    r = relations.groupBy(ordinal).agg(F.count("*").alias("relations"))
    both = documents.join(c, ordinal, "left").join(r, ordinal, "left").fillna(0, ["candidates", "relations"])
    return both.where("candidates > 0 or relations > 0")


def row_number_first(df: DataFrame, partition: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn("rn_", F.row_number().over(W.partitionBy(*partition).orderBy(*order))).where("rn_ = 1").drop("rn_")


def control_records(artifacts: DataFrame, revisions: DataFrame, source: str, record_type: str, limit: int) -> DataFrame:
    """source_record_id, raw_json: the first limit current active catalog records of a source whose raw record_type is the given one, by id."""
    current = current_artifacts(artifacts).where((F.col("source") == source) & (F.col("kind") == "catalog_record"))
    found = revisions.select(F.col("id").alias("current_revision_id"), "raw_json").where(F.get_json_object("raw_json", "$.record_type") == record_type)
    return current.join(found, "current_revision_id").select("source_record_id", "raw_json").orderBy("source_record_id").limit(limit)


def connected_artifacts(identifiers: DataFrame, links: DataFrame, addresses: DataFrame) -> DataFrame:
    """source_id, target_id, connection, direction, namespace, value, locator: how artifacts are connected, each edge once.

    identifiers: artifact_id, namespace, value; artifacts that share one are a star around the least of them, not all
    pairs. links: artifact_id, url, relation, locator, and addresses: url, artifact_id: an artifact that links to
    another's address has an edge to it (out), the other one back (in); namespace is the relation and value the URL.
    """
    star = join_identity_star(identifiers, ["namespace", "value"], "artifact_id", F.lit(1.0), F.lit("")).select(
        "source_id", "target_id", F.lit("identifier").alias("connection"), F.lit("shared").alias("direction"), "namespace", "value", F.lit("").alias("locator")
    )
    owners = addresses.groupBy("url").agg(F.min("artifact_id").alias("target_id"))
    linked = lookup_join(links.select(F.col("artifact_id").alias("source_id"), "url", "relation", "locator").distinct(), owners, ["url"], how="inner").where("source_id <> target_id")
    columns = [F.lit("url").alias("connection"), F.lit("out").alias("direction"), F.col("relation").alias("namespace"), F.col("url").alias("value"), F.coalesce("locator", F.lit("")).alias("locator")]
    out = linked.select("source_id", "target_id", *columns)
    back = out.select(F.col("target_id").alias("source_id"), F.col("source_id").alias("target_id"), "connection", F.lit("in").alias("direction"), "namespace", "value", "locator")
    return star.unionByName(out).unionByName(back).distinct()


def artifact_classes(edges: DataFrame) -> DataFrame:
    """artifact_id, links: the number of edges of each connected artifact."""
    return edges.groupBy(F.col("source_id").alias("artifact_id")).agg(F.count("*").alias("links"))
