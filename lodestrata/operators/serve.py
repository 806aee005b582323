"""Lookups, rankings, coverage and exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .entries import WEIGHT_RELATIONS

MOST_ROWS = 1000


def search_rank(name: Column, identifier: Column, query: str) -> Column:
    """0 exact name, 1 prefix, 0 substring of an identifier, 2 substring of the name, 3 for an empty query; null for no match, in this order."""
    q = query.casefold().strip()
    if not q:
        return F.lit(3)
    name, identifier = F.lower(name), F.lower(identifier)
    return F.when(name == q, 0).when(name.startswith(q), 1).when(identifier.contains(q), 0).when(name.contains(q), 2)


def _at_most(limit: int, most: int) -> int:
    if not 0 <= limit <= most:
        raise ValueError(f"at most {most} rows can be asked for, not {limit}")
    return limit


def topk_search(models: DataFrame, query: str, limit: int = 50) -> DataFrame:
    """id, name, confidence, rank of the best matches: by rank, confidence, name, id. models has id, name, normalized_name, identifier, confidence."""
    ranked = models.withColumn("rank", search_rank(F.col("normalized_name"), F.col("identifier"), query)).where("rank is not null")
    best = ranked.groupBy("id").agg(F.min_by(F.struct("name", "confidence", "rank"), F.struct("rank", "name", "confidence")).alias("m"))
    return best.select("id", "m.*").orderBy("rank", F.desc("confidence"), "name", "id").limit(_at_most(limit, 500))


def topk_frontier_claim(frontier: DataFrame, now: Column, limit: int, lease_seconds: int = 3600, refresh_seconds: int = 86400) -> DataFrame:
    """The URLs to fetch next: pending ones, fetched ones (done or failed) after refresh_seconds, claimed ones whose lease ran out. Never fetched first, then by first_seen_at and url; attempts counted up."""
    due = (
        (F.col("status") == "pending")
        | (F.col("status").isin("done", "failed") & (F.col("last_fetched_at") <= now - F.make_dt_interval(secs=F.lit(refresh_seconds).cast("decimal(18,6)"))))
        | ((F.col("status") == "claimed") & (F.col("claimed_at") <= now - F.make_dt_interval(secs=F.lit(lease_seconds).cast("decimal(18,6)"))))
    )
    claimed = frontier.where(due).orderBy(F.col("last_fetched_at").isNotNull(), "first_seen_at", "url").limit(_at_most(limit, MOST_ROWS))
    return claimed.withColumns({"status": F.lit("claimed"), "attempts": F.col("attempts") + 1, "claimed_at": now})


def topk_by_status(df: DataFrame, status: str | None, order: list[str], limit: int, column: str = "status") -> DataFrame:
    """Rows of a status (all for None), sorted; for frontier and dead letters."""
    return (df.where(F.col(column) == status) if status is not None else df).orderBy(*order).limit(_at_most(limit, MOST_ROWS))


# Suffixes of weight files and of files never fetched.
WEIGHT_FILE = r"(?i)\.(?:safetensors|gguf|ggml|bin|pt|pth|ckpt|onnx|h5|msgpack|npz|tflite)$"
BINARY_FILE = r"(?i)\.(?:zip|gz|tar|tgz|bz2|xz|7z|rar|exe|dmg|iso|png|jpe?g|gif|svg|webp|mp[34]|avi|mov|woff2?|ttf|css|js)$"


def topk_frontier_promote(discoveries: DataFrame, held: DataFrame, limit: int) -> DataFrame:
    """url of declared weight files not held yet, the first seen first. discoveries has url, relation, locator, first_seen_at; a locator text:… is a mention, not a declaration."""
    declared = F.col("relation").isin("weights", "checkpoint", "model_artifact") & ~F.coalesce(F.col("locator").startswith("text:"), F.lit(False)) & F.regexp_replace("url", r"[?#].*$", "").rlike(WEIGHT_FILE)
    new = discoveries.where(declared).groupBy("url").agg(F.min("first_seen_at").alias("first_seen_at")).join(held.select("url"), "url", "left_anti")
    return new.orderBy("first_seen_at", "url").limit(limit).select("url")


def frontier_policy(urls: DataFrame, skipped_hosts: list[str], most_depth: int) -> DataFrame:
    """urls with action: ignore beyond the depth, on skipped hosts and binary files; reference for weights and PDFs; else fetch."""
    path = F.regexp_replace("url", r"[?#].*$", "")
    host = F.lower(F.regexp_extract("url", r"^https?://([^/:?#]+)", 1))
    action = F.when((F.col("depth") > most_depth) | host.isin(*skipped_hosts) | path.rlike(BINARY_FILE), "ignore").when(path.rlike(WEIGHT_FILE) | path.rlike(r"(?i)\.pdf$"), "reference").otherwise("fetch")
    return urls.withColumn("action", action)


def agg_stats(tables: dict[str, DataFrame], conditions: dict[str, tuple[str, Column]]) -> DataFrame:
    """name, value: rows of each table, and of each condition (table, predicate)."""
    wanted: dict[str, list[tuple[str, Column]]] = {t: [(t, F.count("*"))] for t in tables}
    for name, (t, predicate) in conditions.items():
        wanted[t].append((name, F.count_if(predicate)))
    out = None
    for t, items in wanted.items():
        one = tables[t].agg(*[c.alias(f"c{i}") for i, (_, c) in enumerate(items)])
        rows = one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(f"c{i}").alias("value")) for i, (n, _) in enumerate(items)])).alias("x")).select("x.*")
        out = rows if out is None else out.unionByName(rows)
    return out


def agg_source_status(runs: DataFrame) -> DataFrame:
    """The last run of each source, by id."""
    columns = [c for c in runs.columns if c != "source"]
    return runs.groupBy("source").agg(F.max_by(F.struct(*columns), "id").alias("r")).select("source", "r.*")


def agg_bucket_recall(expected: DataFrame, found: DataFrame) -> DataFrame:
    """bucket, total, found, recall, and a row for all. expected has bucket and normalized_name, found normalized_name; buckets differ by more than case, the first spelling names them."""
    hit = expected.join(found.select("normalized_name", F.lit(1).alias("hit")).distinct(), "normalized_name", "left").withColumn("hit", F.coalesce("hit", F.lit(0)))
    groups = hit.groupBy(F.lower("bucket").alias("b")).agg(F.min("bucket").alias("bucket"), F.count("*").alias("total"), F.sum("hit").alias("found")).drop("b")
    every = hit.agg(F.lit("all").alias("bucket"), F.count("*").alias("total"), F.coalesce(F.sum("hit"), F.lit(0)).alias("found"))
    return groups.unionByName(every).withColumn("recall", F.when(F.col("total") == 0, 1.0).otherwise(F.col("found") / F.col("total")))


def agg_benchmark(rows: DataFrame, index: DataFrame) -> DataFrame:
    """normalized_name, first_row, spellings, rows, found: the rows of a benchmark sheet by name, the first row standing for all. rows has row, name, normalized_name."""
    groups = rows.groupBy("normalized_name").agg(F.min("row").alias("first_row"), F.array_sort(F.collect_set("name")).alias("spellings"), F.count("*").alias("rows"))
    return groups.join(index.select("normalized_name", F.lit(True).alias("found")).distinct(), "normalized_name", "left").withColumn("found", F.coalesce("found", F.lit(False)))


def agg_release_weights(files: DataFrame) -> DataFrame:
    """release_id, files, complete: union of safe filenames, and whether every listing was complete. files has release_id, file, safe, complete."""
    return files.groupBy("release_id").agg(F.array_sort(F.collect_set(F.when(F.col("safe"), F.col("file")))).alias("files"), F.bool_and("complete").alias("complete"))


def agg_source_manifest(configured: DataFrame, observed: DataFrame) -> DataFrame:
    """source, configured, observed, records of all sources on either side."""
    met = configured.select("source", F.lit(True).alias("configured")).distinct().join(observed, "source", "full_outer")
    return met.select("source", F.coalesce("configured", F.lit(False)).alias("configured"), F.col("records").isNotNull().alias("observed"), F.coalesce("records", F.lit(0)).alias("records"))


def sort_export(df: DataFrame) -> DataFrame:
    """All fields from the left, nulls first."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in df.columns])


def numeric_order(column: str) -> list[Column]:
    """Ids of digits by value: by length, then text."""
    return [F.length(column), F.col(column)]


def has_weight_url(discoveries: DataFrame) -> Column:
    return F.lower("relation").isin(*WEIGHT_RELATIONS)


def model_detail(model_id: str, models: DataFrame, aliases: DataFrame, identifiers: DataFrame, links: DataFrame) -> DataFrame:
    """One row: the model with its aliases, identifiers and artifacts, each sorted; none for an unknown id."""
    one = models.where(F.col("id") == model_id)

    def listed(df: DataFrame, *columns: str, name: str) -> DataFrame:
        return df.where(F.col("model_id") == model_id).groupBy(F.col("model_id").alias("id")).agg(F.array_sort(F.collect_set(F.struct(*columns) if len(columns) > 1 else F.col(columns[0]))).alias(name))

    out = one
    for part in (listed(aliases, "alias", name="aliases"), listed(identifiers, "namespace", "value", name="identifiers"), listed(links, "artifact_id", "status", name="artifacts")):
        out = out.join(part, "id", "left")
    return out
