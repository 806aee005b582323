"""Entries: model candidates of all sources joined by exact identifiers, with their resources and citations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .skew import lookup_join

# Relations by category.
WEIGHT_RELATIONS = ("checkpoint", "inference_artifact", "linked_model_artifact", "model_artifact", "model_weights", "weights")
CODE_RELATIONS = ("code", "code_reference", "implementation", "official_implementation", "source_implementation")
PAPER_RELATIONS = ("associated_paper", "doi", "paper", "paper_reference", "publication", "source_paper")
CARD_RELATIONS = ("model_card", "model_card_metadata", "model_config", "provider_page")
CITATION_RELATIONS = ("cites", "cited_by", "is-cited-by")
CHECKPOINT_RELATIONS = ("checkpoint", "model_weights", "weights")
MERGING_PREDICATES = ("mirrors", "hosted_huggingface_model")


def resource_category(relation: Column, kind: Column) -> Column:
    low = F.lower(relation)
    return (
        F.when(low.isin(*WEIGHT_RELATIONS), "weights").when(low.isin(*CODE_RELATIONS), "code").when(low.isin(*PAPER_RELATIONS), "paper").when(low.isin(*CARD_RELATIONS), "model")
        .when((low == "seed") & (kind == "paper"), "paper").otherwise("resource")
    )


def entry_candidates(seeds: DataFrame) -> DataFrame:
    """One row per declared model of a seed: its ids, tags of seed and model, links of the record or scoped to it, and the seed's own address.

    seeds has source, source_record_id, kind, canonical_url, tags, models (array of local_id, name, tags, identifiers) and links (array of url, relation, model_local_ids).
    """
    each = seeds.withColumn("m", F.explode("models"))
    own = F.filter("links", lambda l: (F.size(F.coalesce(l["model_local_ids"], F.array().cast("array<string>"))) == 0) | F.array_contains(l["model_local_ids"], F.col("m.local_id")))
    seed = F.array(F.struct(F.col("canonical_url").alias("url"), F.lit("seed").alias("relation")))
    resources = F.concat(seed, F.transform(own, lambda l: F.struct(l["url"].alias("url"), l["relation"].alias("relation"))))
    return each.select(
        "source", "source_record_id", F.col("m.local_id").alias("local_id"), F.col("m.name").alias("name"), F.array_sort(F.array_union("tags", F.coalesce("m.tags", F.array().cast("array<string>")))).alias("tags"),
        F.array_sort(F.array_distinct("m.identifiers")).alias("identifiers"), resources.alias("resources"),
    )


def dangling_scopes(seeds: DataFrame) -> DataFrame:
    """Links scoped to models that their seed does not declare."""
    known = F.transform("models", lambda m: m["local_id"])
    each = seeds.select("source", "source_record_id", known.alias("known"), F.explode("links").alias("l")).select("source", "source_record_id", "known", F.explode("l.model_local_ids").alias("local_id"))
    return each.where(~F.array_contains("known", F.col("local_id")))


def checkpoint_bridges(resources: DataFrame) -> DataFrame:
    """candidate, anchor: candidates that one checkpoint URL makes the same.

    resources has candidate, source, source_record_id, url, relation, of the candidate's own record. The URL
    must be called a checkpoint by all that call it weights, by one candidate a record, in two sources.
    """
    called = resources.where(F.lower("relation").isin(*CHECKPOINT_RELATIONS)).groupBy("url", "candidate", "source", "source_record_id").agg(F.bool_or(F.lower("relation") == "checkpoint").alias("explicit"))
    records = called.groupBy("url", "source", "source_record_id").agg(F.count("*").alias("n"), F.bool_and("explicit").alias("explicit"))
    urls = records.groupBy("url").agg(F.max("n").alias("n"), F.bool_and("explicit").alias("explicit"), F.count_distinct("source").alias("sources")).where("n = 1 and explicit and sources >= 2")
    return called.join(urls.select("url"), "url", "left_semi").select("candidate", F.concat(F.lit("checkpoint:"), "url").alias("anchor"))


def components(members: DataFrame) -> DataFrame:
    """node, component: connected components of the graph in which node touches anchor; component is the least node.

    members has node and anchor. Labels alternate between anchors and nodes, each taking the least it
    sees, and jump to the label of their label, so rounds grow with the logarithm of the longest chain.
    Every round is two aggregates and a cut in the shared checkpoint folder; nothing reaches the driver
    but the count of changes.
    """
    links = cut_lineage(members.where("node is not null and anchor is not null").select("node", "anchor").distinct())
    labels = links.select("node").distinct().withColumn("component", F.col("node"))
    changed = 1
    while changed:
        labelled = lookup_join(links, labels, ["node"])
        least = labelled.groupBy("anchor").agg(F.min("component").alias("least"))
        seen = lookup_join(links, least, ["anchor"]).groupBy("node").agg(F.min("least").alias("new"))
        stepped = labels.join(seen, "node").select("node", F.col("component").alias("old"), F.least("component", "new").alias("component"))
        jumped = lookup_join(stepped, stepped.select(F.col("node").alias("component"), F.col("component").alias("next")), ["component"])
        after = cut_lineage(jumped.select("node", "old", F.coalesce(F.least("component", "next"), "component").alias("component")))
        changed = after.where("old <> component").limit(1).count()
        labels = after.select("node", "component")
    return labels


def agg_entry_merge(candidates: DataFrame) -> DataFrame:
    """component, canonical_name, identifiers, aliases, members: one entry per component, members their number.

    candidates has component, name, normalized_name, source, source_record_id, local_id, identifiers (array of text). The
    canonical name is the first by (has identifiers, normalized name, name, source, record, local id).
    The arrays hold distinct values; the members themselves are rows, see entry_members.
    """
    order = F.struct((F.size("identifiers") == 0).alias("a"), "normalized_name", "name", "source", "source_record_id", "local_id")
    heads = candidates.groupBy("component").agg(F.min_by("name", order).alias("canonical_name"), F.array_sort(F.collect_set("name")).alias("aliases"))
    ids = candidates.select("component", F.explode("identifiers").alias("i")).groupBy("component").agg(F.array_sort(F.collect_set("i")).alias("identifiers"))
    members = entry_members(candidates).groupBy("component").agg(F.count("*").alias("members"))
    return heads.join(ids, "component", "left").join(members, "component").withColumn("identifiers", F.coalesce("identifiers", F.array().cast("array<string>")))


def entry_members(candidates: DataFrame) -> DataFrame:
    return candidates.select("component", "source", "source_record_id", "local_id").distinct()


def entry_id(anchors: Column) -> Column:
    """entry: and the sha256 of {"anchors":[…]} over the sorted anchors. Anchors are ids without characters that JSON escapes."""
    quoted = F.concat_ws(",", F.transform(F.array_sort(anchors), lambda a: F.concat(F.lit('"'), a, F.lit('"'))))
    return F.concat(F.lit("entry:"), F.sha2(F.concat(F.lit('{"anchors":['), quoted, F.lit("]}")), 256))


def entry_plan(candidates: DataFrame) -> DataFrame:
    """source, source_record_id, step, action, url: what to fetch or keep for each candidate's resources, in order; weights are kept as references."""
    each = candidates.select("source", "source_record_id", "local_id", F.posexplode("resources").alias("step", "r"))
    action = F.when(F.lower("r.relation").isin(*WEIGHT_RELATIONS), "reference").otherwise("fetch")
    return each.select("source", "source_record_id", "local_id", "step", action.alias("action"), F.col("r.url").alias("url"))


def unique_owner(df: DataFrame, key: list[str], owner: str) -> DataFrame:
    """key, owner of the keys that exactly one owner has."""
    return df.groupBy(*key).agg(F.count_distinct(owner).alias("n_"), F.min(owner).alias(owner)).where("n_ = 1").drop("n_")


def citations_closed(links: DataFrame, owners: DataFrame) -> DataFrame:
    """source_id, target_id: citations between entries.

    links has entry, predicate, direction and key; owners has key and entry. Keys of several entries
    and self edges are left out; cited_by and an incoming direction each turn the edge, a symmetric one is none.
    """
    target = unique_owner(owners, ["key"], "entry").withColumnRenamed("entry", "other")
    met = links.where(F.lower("predicate").isin(*CITATION_RELATIONS) & ~F.coalesce(F.col("direction") == "symmetric", F.lit(False))).join(target, "key")
    turned = (F.lower("predicate") != "cites") != F.coalesce(F.col("direction") == "incoming", F.lit(False))
    edges = met.select(F.when(turned, F.col("other")).otherwise(F.col("entry")).alias("source_id"), F.when(turned, F.col("entry")).otherwise(F.col("other")).alias("target_id"))
    return edges.where("source_id <> target_id").distinct()


def evidence_attach(evidence: DataFrame, candidates: DataFrame) -> DataFrame:
    """evidence (record, identifier, url, relation) of weights with candidate, where the record's identifiers lead to exactly one candidate of another record.

    An identifier in the candidates of three records leads to two others whatever the record, so only
    the least and greatest candidate of up to two records of each identifier are met, never all pairs.
    """
    owned = candidates.groupBy("identifier", F.col("record").alias("owner")).agg(F.min("candidate").alias("low"), F.max("candidate").alias("high"))
    sizes = owned.groupBy("identifier").agg(F.count("*").alias("owners"))
    few = owned.join(sizes.where("owners <= 2"), "identifier")
    many = sizes.where("owners > 2").select("identifier", F.lit(True).alias("many"))
    asked = evidence.select("record", "identifier").distinct()
    ambiguous = asked.join(many, "identifier").select("record").distinct()
    met = asked.join(few, "identifier").where("record <> owner").groupBy("record").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    single = met.where("low = high").join(ambiguous, "record", "left_anti").select("record", F.col("low").alias("candidate"))
    return evidence.where(F.lower("relation").isin(*WEIGHT_RELATIONS)).join(single, "record").select("record", "url", "relation", "candidate").distinct()


def model_relation_target(relations: DataFrame, members: DataFrame, identifiers: DataFrame) -> DataFrame:
    """relations with target_entry: the entry of the same record's local id, else of a target identifier that exactly one entry has."""
    local = members.select("record", F.col("local_id").alias("target_local_id"), F.col("entry").alias("by_local"))
    exact = unique_owner(identifiers, ["identifier"], "entry").select(F.col("identifier").alias("target_identifier"), F.col("entry").alias("by_identifier"))
    met = relations.join(local, ["record", "target_local_id"], "left").join(exact, "target_identifier", "left")
    return met.withColumn("target_entry", F.coalesce("by_local", "by_identifier")).drop("by_local", "by_identifier")
