"""The registry's tables: validation, revisions, identity by exact identifiers, tombstones, commits."""

from __future__ import annotations

import hashlib
import json
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import stable_id
from .checks import Violation, flagged

KINDS = ("paper", "code_repository", "model_card", "weights", "provider_page", "blog_post", "catalog_record", "web_page", "other")
STATUS_ORDER = ("stub", "candidate", "documented", "released")


def status_rank(status: Column) -> Column:
    rank = F.when(F.lit(False), 0)
    for n, name in enumerate(STATUS_ORDER):
        rank = rank.when(status == name, n)
    return rank


def record_rules() -> dict[str, Column]:
    """What a record must satisfy: source_record_id, kind, canonical_url, title, models (array of local_id, name, confidence), links (array with model_local_ids), deleted."""
    known = F.transform("models", lambda m: m["local_id"])
    scoped = F.flatten(F.transform("links", lambda l: F.coalesce(l["model_local_ids"], F.array().cast("array<string>"))))
    said = F.size("models") + F.size("links") > 0
    return {
        "missing text": (F.trim("source_record_id") != "") & (F.trim("canonical_url") != "") & ((F.trim("title") != "") | F.col("deleted")),
        "unknown kind": F.col("kind").isin(*KINDS),
        "deleted record with claims": ~(F.col("deleted") & said),
        "confidence outside 0 to 1": F.forall("models", lambda m: m["confidence"].between(0, 1)),
        "repeated local id": F.size(F.array_distinct(known)) == F.size(known),
        "scope of an unknown model": F.size(F.array_except(scoped, known)) == 0,
    }


def validate_records(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad): bad has issue, the first rule broken."""
    bad = flagged(records, record_rules())
    rules = record_rules()
    good = records
    for rule in rules.values():
        good = good.where(F.coalesce(rule, F.lit(False)))
    return good, bad


def quarantine(bad: DataFrame, dead_letters: DataFrame, source: str, stage: str, run_id: int, now: str) -> DataFrame:
    """dead_letters with the bad records: one row per (source, record, stage, error), attempts counted up."""
    new = bad.groupBy(F.lit(source).alias("source"), "source_record_id", F.lit(stage).alias("stage"), F.col("issue").alias("error")).agg(F.count("*").alias("new"))
    keys = ["source", "source_record_id", "stage", "error"]
    met = dead_letters.join(new, keys, "full_outer")
    seen = F.col("new").isNotNull()
    return met.select(
        *keys, (F.coalesce("attempts", F.lit(0)) + F.coalesce("new", F.lit(0))).alias("attempts"), F.coalesce("first_seen_at", F.lit(now)).alias("first_seen_at"),
        F.when(seen, F.lit(now)).otherwise(F.col("last_seen_at")).alias("last_seen_at"), F.when(seen, F.lit(run_id)).otherwise(F.col("run_id")).alias("run_id"),
    )


def revision_upsert(revisions: DataFrame, records: DataFrame) -> DataFrame:
    """revisions with a new row per (artifact_id, content) that is not there yet; replay adds nothing."""
    made = records.select(stable_id("revision", F.col("artifact_id"), F.sha2("content", 256)).alias("id"), "artifact_id", F.sha2("content", 256).alias("revision_hash")).distinct()
    return revisions.select("id", "artifact_id", "revision_hash").unionByName(made.join(revisions.select("id"), "id", "left_anti"))


def prune_derived(derived: DataFrame, fresh: DataFrame, revision: str = "artifact_revision_id", extractor: str = "extractor") -> DataFrame:
    """derived where the rows of a revision and extractor that fresh extracts anew are replaced."""
    return derived.join(fresh.select(revision, extractor).distinct(), [revision, extractor], "left_anti").unionByName(fresh)


def snapshot_tombstones(active: DataFrame, seen: DataFrame, key: str, most_lost: float | None = 0.25) -> DataFrame:
    """Active rows that an authoritative snapshot lacks. An empty snapshot, or one that loses more than most_lost, is refused; None lifts that."""
    gone = active.join(seen.select(key).distinct(), key, "left_anti")
    if most_lost is not None:
        before, lost = active.count(), gone.count()
        if before and (seen.limit(1).count() == 0 or lost > most_lost * before):
            raise Violation(f"the snapshot would remove {lost} of {before} rows")
    return gone


def status_merge(hints: DataFrame, key: str) -> DataFrame:
    """key, status, confidence: highest rank and highest confidence."""
    rank = status_rank(F.col("status"))
    return hints.groupBy(key).agg(F.max_by("status", rank).alias("status"), F.max("confidence").alias("confidence"))


def resolve_model(hints: DataFrame, claims: DataFrame, artifacts: DataFrame) -> DataFrame:
    """hints (artifact_id, local_id, identifiers) with model_id and resolution_status.

    Only bound claims on current revisions resolve, and only exact identifiers, names never: one
    model is exact_identifier, several are identifier_conflict with an id scoped to the source, none is
    exact_identifier_new with an id from the first identifier, no identifier is source_scoped. Hints of one
    batch that share an unbound first identifier meet in the same new id.
    """
    current = artifacts.where("active = 1").select(F.col("current_revision_id").alias("artifact_revision_id"))
    bound = claims.where("resolution_status = 'bound'").join(current, "artifact_revision_id", "left_semi").select(F.concat_ws(":", F.lower("namespace"), "value").alias("identifier"), "model_id")
    # Of an identifier's models the least and the greatest tell whether there is one, without pairing claims with hints.
    bound = bound.groupBy("identifier").agg(F.min("model_id").alias("low"), F.max("model_id").alias("high"))
    each = hints.select("artifact_id", "local_id", F.explode("identifiers").alias("identifier"))
    found = each.join(bound, "identifier").groupBy("artifact_id", "local_id").agg(F.min("low").alias("found"), F.max("high").alias("high"))
    found = found.withColumn("n", F.when(F.col("found") == F.col("high"), 1).otherwise(2)).drop("high")
    met = hints.join(found, ["artifact_id", "local_id"], "left")
    first = F.get(F.array_sort("identifiers"), 0)
    scoped = stable_id("model", F.col("artifact_id"), F.col("local_id"))
    status = F.when(F.col("n") == 1, "exact_identifier").when(F.col("n") > 1, "identifier_conflict").when(first.isNotNull(), "exact_identifier_new").otherwise("source_scoped")
    model = F.when(F.col("n") == 1, F.col("found")).when((F.col("n") > 1) | first.isNull(), scoped).otherwise(stable_id("model", first))
    return met.withColumns({"model_id": model, "resolution_status": status}).drop("n", "found")


def resolve_release(hints: DataFrame, releases: DataFrame) -> DataFrame:
    """hints (model_id, identifier, version, revision) with release_id and resolution_status: an identifier bound to a release of another model is a conflict."""
    bound = releases.select("identifier", F.col("release_id").alias("found"), F.col("model_id").alias("owner"))
    met = hints.join(bound, "identifier", "left")
    own = F.col("found").isNotNull() & (F.col("owner") == F.col("model_id"))
    made = stable_id("release", F.col("model_id"), F.coalesce("identifier", "revision", "version", F.lit("")))
    status = F.when(own, "exact_identifier").when(F.col("found").isNotNull(), "identifier_conflict").when(F.col("identifier").isNotNull(), "exact_identifier_new").otherwise("source_scoped")
    return met.withColumns({"release_id": F.when(own, F.col("found")).otherwise(made), "resolution_status": status}).drop("found", "owner")


def resolve_relation(relations: DataFrame, subjects: DataFrame, bound: DataFrame) -> DataFrame:
    """relations (record, subject_local_id, target_identifiers) with subject_model_id, target_model_id and resolution_status."""
    subject = subjects.select("record", F.col("local_id").alias("subject_local_id"), F.col("model_id").alias("subject_model_id"))
    keyed = relations.withColumn("row_", F.monotonically_increasing_id())
    known = bound.groupBy("identifier").agg(F.min("model_id").alias("low"), F.max("model_id").alias("high"))
    targets = keyed.select("row_", F.explode("target_identifiers").alias("identifier")).join(known, "identifier")
    found = targets.groupBy("row_").agg(F.min("low").alias("one"), F.max("high").alias("high")).withColumn("n", F.when(F.col("one") == F.col("high"), 1).otherwise(2)).drop("high")
    met = keyed.join(subject, ["record", "subject_local_id"], "left").join(found, "row_", "left")
    status = F.when(F.col("subject_model_id").isNull(), "unresolved_subject").when(F.col("n") > 1, "conflicting_target_identifiers").when(F.col("n").isNull(), "unresolved_target").otherwise("resolved")
    return met.withColumns({"target_model_id": F.when(F.col("n") == 1, F.col("one")), "resolution_status": status}).drop("row_", "n", "one")


def persist_links(records: DataFrame, frontier: DataFrame, depth: int) -> DataFrame:
    """frontier with the web links of records (artifact_id, url, relation, mentioned): its own address is no link, mentions in text only count as implementations or repositories; depth is the least."""
    wanted = ~F.col("mentioned") | F.col("relation").isin("implementation", "official_implementation") | F.col("url").rlike(r"^https?://(www\.)?github\.com/[^/]+/[^/]+$")
    new = records.where(F.col("url").rlike("^https?://") & (F.col("url") != F.col("own_url")) & wanted).select("url", F.lit(depth).alias("depth"))
    return frontier.select("url", "depth").unionByName(new).groupBy("url").agg(F.min("depth").alias("depth"))


# Commits: a snapshot of tables, of which HEAD.json names one. Local or mounted file systems only, as the swap is a rename.


def sink_commit(tables: dict[str, DataFrame], root: str) -> dict:
    """Writes the tables as one commit and moves HEAD to it; tables that are the parent's own files are taken over. Returns the manifest."""
    head = read_head(root)
    commit = uuid.uuid4().hex
    manifest = {"commit": commit, "parent": head and head["commit"], "tables": {}}
    for name, df in sorted(tables.items()):
        digest = table_digest(df)
        kept = head and head["tables"].get(name)
        if kept and kept["digest"] == digest:
            manifest["tables"][name] = kept
        else:
            path = f"{root}/commits/{commit}/{name}.parquet"
            df.write.option("compression", "zstd").parquet(path)
            manifest["tables"][name] = {"path": path, "digest": digest, "rows": df.sparkSession.read.parquet(path).count()}
    manifest["state"] = hashlib.sha256(json.dumps({n: t["digest"] for n, t in manifest["tables"].items()}, sort_keys=True).encode()).hexdigest()
    os.makedirs(root, exist_ok=True)
    with open(f"{root}/HEAD.{commit}", "w") as out:
        json.dump(manifest, out, sort_keys=True)
        out.flush()
        os.fsync(out.fileno())
    _move_head(root, commit, manifest["parent"])
    return manifest


def _move_head(root: str, commit: str, parent: str | None) -> None:
    """Moves HEAD from its parent to commit; another commit in between, or one that is being made, is an error."""
    try:
        lock = os.open(f"{root}/HEAD.lock", os.O_CREAT | os.O_EXCL)
    except FileExistsError:
        os.remove(f"{root}/HEAD.{commit}")
        raise Violation("another commit is being made") from None
    try:
        head = read_head(root)
        if (head and head["commit"]) != parent:
            os.remove(f"{root}/HEAD.{commit}")
            raise Violation("HEAD has moved since the commit was begun")
        os.replace(f"{root}/HEAD.{commit}", f"{root}/HEAD.json")
    finally:
        os.close(lock)
        os.remove(f"{root}/HEAD.lock")


def read_head(root: str) -> dict | None:
    try:
        with open(f"{root}/HEAD.json") as head:
            return json.load(head)
    except FileNotFoundError:
        return None


def table_digest(df: DataFrame) -> str:
    """Independent of the order of rows and files: count and sums of a 64-bit hash over the columns by name, in two halves so that no sum overflows."""
    row = F.xxhash64(*[F.col(c).cast("string") if not isinstance(t, str) or t in ("void",) else F.to_json(F.struct(F.col(c))) for c, t in sorted(df.dtypes)])
    sums = df.select(row.alias("h")).agg(F.count("*"), F.sum(F.shiftright("h", 32)), F.sum(F.col("h").bitwiseAND(0xFFFFFFFF))).first()
    return hashlib.sha256(json.dumps([sorted(df.dtypes), [int(x or 0) for x in sums]]).encode()).hexdigest()


def scan_store(spark: SparkSession, root: str, name: str, verify: bool = False) -> DataFrame:
    """A table of the commit that HEAD names; verify recomputes rows and digest and refuses a difference."""
    head = read_head(root)
    if head is None or name not in head["tables"]:
        raise Violation(f"no committed table {name}")
    entry = head["tables"][name]
    df = spark.read.parquet(entry["path"])
    if verify and (df.count() != entry["rows"] or table_digest(df) != entry["digest"]):
        raise Violation(f"table {name} differs from its manifest")
    return df
