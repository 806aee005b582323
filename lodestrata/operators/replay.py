"""State from ordered snapshots and diffs of papers and citations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut_lineage
from .checks import assert_empty, orphans


def order_gaps(shards: DataFrame, group: list[str], position: str) -> DataFrame:
    """Groups whose positions are not 0, 1, 2 … each once."""
    seen = shards.groupBy(*group).agg(F.count("*").alias("n"), F.count_distinct(position).alias("kinds"), F.min(position).alias("low"), F.max(position).alias("high"))
    return seen.where("low <> 0 or high + 1 <> kinds or n <> kinds")


def chain_breaks(diffs: DataFrame, group: list[str], release: str) -> DataFrame:
    """Diffs that do not go on from the one before, or last ones that do not end at the release. diffs has diff_index, from_release and to_release, one row a diff."""
    order = W.partitionBy(*group).orderBy("diff_index")
    before, after = F.lag("to_release").over(order), F.lead("diff_index").over(order)
    return diffs.withColumns({"before": before, "after": after}).where((F.col("before") != F.col("from_release")) | (F.col("after").isNull() & (F.col("to_release") != F.col(release))))


def transitions_disagree(diffs: DataFrame) -> DataFrame:
    """Transitions that not all datasets share. diffs has dataset, diff_index, from_release, to_release."""
    total = diffs.agg(F.count_distinct("dataset").alias("all"))
    each = diffs.groupBy("diff_index", "from_release", "to_release").agg(F.count_distinct("dataset").alias("n"))
    return each.join(F.broadcast(total), F.col("n") != F.col("all"))


def citation_events(changes: DataFrame, order: list[Column]) -> DataFrame:
    """citing, cited, operation, event_index: the events in one total order from 0.

    The index is a running number within ranges of the order plus the counts of the ranges before,
    so no single task sorts all events. changes has citing, cited, operation and the order's columns.
    """
    keyed = changes.select("citing", "cited", "operation", F.struct(*order).alias("o_"))
    parts = int(changes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = keyed.repartitionByRange(parts, "o_").sortWithinPartitions("o_").withColumn("p_", F.spark_partition_id()).withColumn("m_", F.monotonically_increasing_id())
    local = cut_lineage(ranged.withColumn("i_", F.col("m_").bitwiseAND(F.lit((1 << 33) - 1))))  # ranges are drawn by sampling: one drawing for both uses
    sizes = local.groupBy("p_").agg(F.count("*").alias("n_"))  # one row a partition
    before = sizes.withColumn("before_", F.coalesce(F.sum("n_").over(W.orderBy("p_").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("n_")
    return local.join(F.broadcast(before), "p_").select("citing", "cited", "operation", (F.col("before_") + F.col("i_")).alias("event_index"))


def citation_state(events: DataFrame) -> DataFrame:
    """citing, cited, tombstone, event_index: the last event of each edge."""
    last = F.max_by(F.col("operation"), "event_index")
    return events.groupBy("citing", "cited").agg((last == "delete").alias("tombstone"), F.max("event_index").alias("event_index"))


def citation_rejects(events: DataFrame) -> DataFrame:
    """Deletes of edges that are not active."""
    before = F.lag("operation").over(W.partitionBy("citing", "cited").orderBy("event_index"))
    return events.withColumn("before", before).where("operation = 'delete' and coalesce(before, 'delete') = 'delete'").drop("before")


def active(state: DataFrame) -> DataFrame:
    return state.where(~F.col("tombstone"))


def join_snapshot_state(papers: DataFrame, abstracts: DataFrame, aliases: DataFrame, key: str, alias: str) -> DataFrame:
    """papers with the columns of abstracts and aliases, the sorted distinct aliases; both may be missing, orphans are an error."""
    assert_empty(orphans(abstracts, papers, [key]), "abstract without a paper")
    assert_empty(orphans(aliases, papers, [key]), "alias without a paper")
    grouped = aliases.groupBy(key).agg(F.sort_array(F.collect_set(alias)).alias("aliases"))
    return papers.join(abstracts, key, "left").join(grouped, key, "left").withColumn("aliases", F.coalesce("aliases", F.array().cast("array<string>")))


def alias_conflicts(aliases: DataFrame, alias: str, owner: str) -> DataFrame:
    """alias, owners: aliases of more than one owner."""
    return aliases.groupBy(alias).agg(F.count_distinct(owner).alias("owners")).where("owners > 1")


# The phases of one transition, in order.
PHASES = (("papers", "upsert"), ("abstracts", "upsert"), ("paper-ids", "upsert"), ("abstracts", "delete"), ("paper-ids", "delete"), ("papers", "delete"))


def phase(dataset: Column, operation: Column) -> Column:
    made = F.when(F.lit(False), 0)
    for n, (d, o) in enumerate(PHASES):
        made = made.when((dataset == d) & (operation == o), n)
    return made


def replay_diff_state(events: DataFrame, key: str) -> DataFrame:
    """key, tombstone, paper, abstract, aliases after all transitions.

    events has key, dataset, operation, transition, position, and value (an alias for paper-ids). A
    paper's delete clears its children, so only children after the latest delete count: each part is
    the last of its own events, taken where it is later than that. All of it is aggregates.
    """
    at = F.struct("transition", "phase", "position")
    placed = events.withColumn("phase", phase(F.col("dataset"), F.col("operation"))).withColumn("at", at)
    paper, upsert = F.col("dataset") == "papers", F.col("operation") == "upsert"
    whole = placed.groupBy(key).agg(
        F.max_by(F.struct("operation", "value"), F.when(paper, F.col("at"))).alias("paper"), F.max(F.when(paper & ~upsert, F.col("at"))).alias("cleared"),
        F.max_by(F.struct("operation", "value", "at"), F.when(F.col("dataset") == "abstracts", F.col("at"))).alias("abstract"),
    )
    ids = placed.where("dataset = 'paper-ids'").groupBy(key, "value").agg(F.max_by("operation", "at").alias("last"), F.max("at").alias("seen"))
    live = ids.where("last = 'upsert'").join(whole.select(key, "cleared"), key).where(F.col("cleared").isNull() | (F.col("seen") > F.col("cleared")))
    aliases = live.groupBy(key).agg(F.sort_array(F.collect_set("value")).alias("aliases"))
    kept = F.col("abstract.operation").eqNullSafe("upsert") & (F.col("cleared").isNull() | (F.col("abstract.at") > F.col("cleared")))
    gone = F.col("paper.operation").eqNullSafe("delete")
    out = whole.where("paper is not null").join(aliases, key, "left")
    return out.select(
        key, gone.alias("tombstone"), F.when(~gone, F.col("paper.value")).alias("paper"), F.when(~gone & kept, F.col("abstract.value")).alias("abstract"),
        F.when(~gone, F.coalesce("aliases", F.array().cast("array<string>"))).otherwise(F.array().cast("array<string>")).alias("aliases"),
    )


def replay_rejects(events: DataFrame, key: str) -> DataFrame:
    """Events that cannot apply: children of a paper that is not active, deletes of what is missing."""
    placed = events.withColumn("phase", phase(F.col("dataset"), F.col("operation")))
    order = ["transition", "phase", "position"]
    papers = W.partitionBy(key).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    state = F.last(F.when(F.col("dataset") == "papers", F.col("operation")), ignorenulls=True).over(papers)
    own = F.lag("operation").over(W.partitionBy(key, "dataset", F.when(F.col("dataset") == "paper-ids", F.col("value"))).orderBy(*order))
    told = placed.withColumns({"state": state, "own": own})
    missing = (F.col("operation") == "delete") & (F.coalesce("own", F.lit("delete")) == "delete")
    child = (F.col("dataset") != "papers") & (F.coalesce("state", F.lit("delete")) == "delete")
    return told.where(missing | child).drop("phase", "state", "own")


def dedupe_identical(events: DataFrame, keys: list[str], content: list[str]) -> DataFrame:
    """One row of each set of identical events; see checks.contradictions for the ones that differ."""
    return events.groupBy(*keys, *content).agg(F.count("*").alias("copies"))
