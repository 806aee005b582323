"""Discovery in crawled documents and papers: documents, URL relations and model candidates from one reading."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import stable_id
from ..session import cut_lineage
from .extract import extract_intro_cues, extract_merge, url_relations


class Discovery(NamedTuple):
    documents: DataFrame
    url_relations: DataFrame
    model_candidates: DataFrame


def wet_discovery(documents: DataFrame, key: str = "document_id") -> Discovery:
    """documents (key, source, source_url, title, text, kind) read once, in three tables.

    documents without its text, with n_chars; url_relations: key, url, start, end, relation; model_candidates: key,
    candidate_id, name, normalized_name, confidence, locator. Rows without a text give neither relations nor candidates.
    """
    read = cut_lineage(documents.where(F.col(key).isNotNull()))
    relations = url_relations(read, key)
    found = extract_intro_cues(read.where("text is not null"), key)
    candidates = found.withColumn("candidate_id", stable_id("candidate", F.col(key).cast("string"), F.col("locator"), F.col("normalized_name")))
    return Discovery(read.select(key, "source", "source_url", "title", "kind", F.length("text").alias("n_chars")), relations, candidates)


class Preparation(NamedTuple):
    models: DataFrame
    links: DataFrame


def paper_prepare(records: DataFrame, declared: DataFrame, links: DataFrame, key: str = "source_record_id") -> Preparation:
    """Models and links of records (key, title, text, kind) as they go into the registry.

    declared: key, name, normalized_name, confidence, locator. A record that declares models is not read for
    introductions. links: key, url, relation; a URL of the text that is no link yet becomes one, with the
    relation its words give; of several relations of a text the first by name.
    """
    unread = records.join(declared.select(key).distinct(), key, "left_anti")
    models = extract_merge(declared.select(key, "name", "normalized_name", "confidence", "locator"), extract_intro_cues(unread, key), [key, "normalized_name"])
    said = url_relations(records, key).groupBy(key, "url").agg(F.min("relation").alias("relation"))
    own = links.select(key, "url", "relation").distinct()
    return Preparation(models, own.unionByName(said.join(own.select(key, "url"), [key, "url"], "left_anti")))
