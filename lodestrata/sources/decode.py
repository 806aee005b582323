"""Payloads of lake records decoded into typed rows, with checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import safe_filename
from ..functions.urls import github_repository
from ..operators.serve import WEIGHT_FILE

WET = "uri string, date string, content string, content_type string, content_bytes long, content_sha256 string, warc struct<version:string,record_id:string,type:string>"


def decode_wet_document(records: DataFrame) -> DataFrame:
    """Typed documents with issue, null where text, byte count, digest and record type agree. records has source_record_id and payload_json."""
    d = records.select("source_record_id", F.from_json("payload_json", WET).alias("d")).select("source_record_id", "d.*")
    issue = (
        F.when(F.col("content").isNull(), "no content").when(F.sha2("content", 256) != F.col("content_sha256"), "digest").when(F.octet_length("content") != F.col("content_bytes"), "byte count")
        .when(F.col("warc.type") != "conversion", "record type")
    )
    return d.withColumn("issue", issue)


EVENT = "id string, type string, actor struct<login:string>, repo struct<id:long,name:string,url:string>, created_at string"


def decode_gharchive_event(records: DataFrame) -> DataFrame:
    """event_id, type, repository_id, repository, created_at, issue."""
    e = records.select("source_record_id", F.from_json("payload_json", EVENT).alias("e")).select("source_record_id", "e.*")
    issue = F.when(F.col("repo.id").isNull() | (F.col("repo.id") <= 0), "repository id").when(~F.coalesce(F.col("repo.name").rlike("^[^/]+/[^/]+$"), F.lit(False)), "repository name")
    return e.select("source_record_id", F.col("id").alias("event_id"), "type", F.col("repo.id").alias("repository_id"), F.col("repo.name").alias("repository"), F.to_timestamp("created_at").alias("created_at"), issue.alias("issue"))


def decode_swh_origin(origins: DataFrame) -> DataFrame:
    """origin_url, repository of origins (origin_url, origin_url_base64, origin_url_sha256) whose three forms agree; issue otherwise. A null text is no candidate."""
    raw = F.unbase64("origin_url_base64")
    issue = F.when(F.sha2(raw, 256) != F.col("origin_url_sha256"), "digest").when(F.decode(raw, "UTF-8") != F.col("origin_url"), "text")
    return origins.where("origin_url is not null").select("origin_url", github_repository("origin_url").alias("repository"), issue.alias("issue"))


PRODUCT = "id string, type string, mainTitle string, pids array<struct<scheme:string,value:string>>, originalIds array<string>, instances array<struct<urls:array<string>>>, codeRepositoryUrl string, documentationUrls array<string>"


def project_openaire_software(payloads: DataFrame) -> DataFrame:
    """id, title, identifiers, links (url, relation, locator) of the software products."""
    p = payloads.select(F.from_json("payload_json", PRODUCT).alias("p")).where("p.type = 'software'").select("p.*")
    link = "struct<url:string,relation:string,locator:string>"
    none = F.array().cast(f"array<{link}>")
    code = F.when(F.col("codeRepositoryUrl").isNotNull(), F.array(F.struct(F.col("codeRepositoryUrl").alias("url"), F.lit("code").alias("relation"), F.lit("$.codeRepositoryUrl").alias("locator"))))
    docs = F.transform("documentationUrls", lambda u, i: F.struct(u.alias("url"), F.lit("documentation").alias("relation"), F.format_string("$.documentationUrls[%d]", i).alias("locator")))
    own = F.flatten(F.transform("instances", lambda x, i: F.transform(x["urls"], lambda u, j: F.struct(u.alias("url"), F.lit("instance").alias("relation"), F.format_string("$.instances[%d].urls[%d]", i, j).alias("locator")))))
    ids = F.transform("pids", lambda x: F.struct(F.lower(x["scheme"]).alias("namespace"), x["value"].alias("value")))
    return p.select("id", F.col("mainTitle").alias("title"), ids.alias("identifiers"), F.concat(F.coalesce(code, none), F.coalesce(docs, none), F.coalesce(own, none)).alias("links"))


def project_openaire_relation(payloads: DataFrame) -> DataFrame:
    """source, target, relation of the edges between software and publications or datasets."""
    r = payloads.select(F.from_json("payload_json", "source string, sourceType string, target string, targetType string, relType struct<name:string>").alias("r")).select("r.*")
    kinds = F.array("sourceType", "targetType")
    return r.where(F.array_contains(kinds, "software") & F.exists(kinds, lambda k: k.isin("publication", "dataset"))).select("source", "target", F.col("relType.name").alias("relation"))


RELEASE = "action string, release struct<tag_name:string,name:string,assets:array<struct<name:string,label:string,size:long,digest:string,browser_download_url:string>>>"


def project_release_assets(events: DataFrame, most_assets: int = 1000) -> DataFrame:
    """event_id, file, url, name, confidence, issue: weight files of published releases; too many assets are an issue. events has event_id, type, payload."""
    p = events.where("type = 'ReleaseEvent'").select("event_id", F.from_json("payload", RELEASE).alias("p")).where("p.action = 'published'")
    many = F.size("p.release.assets") > most_assets
    each = p.select("event_id", "p.release.name", "p.release.tag_name", many.alias("many"), F.explode("p.release.assets").alias("a"))
    stem = F.nullif(F.regexp_replace("a.name", r"\.[A-Za-z0-9]+$", ""), F.lit(""))
    name = F.coalesce(stem, F.nullif(F.col("a.label"), F.lit("")), F.nullif(F.col("name"), F.lit("")), "tag_name")
    kept = each.where(F.col("a.name").rlike(WEIGHT_FILE) & safe_filename(F.col("a.name")))
    return kept.select("event_id", F.col("a.name").alias("file"), F.col("a.browser_download_url").alias("url"), name.alias("name"), F.lit(0.2).alias("confidence"), F.when(F.col("many"), "too many assets").alias("issue"))
