"""The registry's operators over the given tables, each beside its SQL.

The tables are not shaped like the registry's, so every query first derives the operator's input; the
SQL derives the same. Times are passed in, never taken from the clock.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import names, text, urls
from ..operators import checks, coverage, entries, extract, relations, replay, serve, store
from ..session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        key = name or f.__name__
        QUERIES[key] = f
        if sql:
            ORACLES[key] = sql
        return f

    return add


# ---- scalars


@query("select model_row, trim(regexp_replace(lower(canonical_name), '[^a-z0-9_]+', ' ', 'g')) name from models")
def normalize_name(spark, folder):
    return table(spark, folder, "models").select("model_row", names.normalize_name("canonical_name").alias("name"))


@query("select doc_id, sha256(text) hash from documents")
def content_hash(spark, folder):
    return table(spark, folder, "documents").select("doc_id", names.content_hash(F.col("text")).alias("hash"))


@query("""select o_orderkey, '{"custkey":' || o_custkey || ',"orderkey":' || o_orderkey || ',"status":"' || o_orderstatus || '"}' json from orders""")
def canonical_json(spark, folder):
    row = F.struct(F.col("o_custkey").alias("custkey"), F.col("o_orderkey").alias("orderkey"), F.col("o_orderstatus").alias("status"))
    return table(spark, folder, "orders").select("o_orderkey", names.canonical_json(row).alias("json"))


@query("""
select doc_id, 'artifact_' || sha256(unhex(lpad(printf('%x', strlen('artifact')), 16, '0')) || encode('artifact')
  || unhex(lpad(printf('%x', strlen(source)), 16, '0')) || encode(source)
  || unhex(lpad(printf('%x', strlen(source_record_id)), 16, '0')) || encode(source_record_id)) id from documents""")
def stable_id(spark, folder):
    return table(spark, folder, "documents").select("doc_id", names.stable_id("artifact", F.col("source"), F.col("source_record_id")).alias("id"))


@query("select document_id, (('0x' || substr(sha256(document_id), 1, 16))::ubigint % 1024)::bigint bucket from documents")
def hash_bucket(spark, folder):
    return table(spark, folder, "documents").select("document_id", names.hash_bucket(F.col("document_id"), 1024).alias("bucket"))


@query("select source_record_id, nullif(ltrim(split_part(source_record_id, ':', 2), '0'), '') corpus from paper_state")
def corpus_id_normalize(spark, folder):
    return table(spark, folder, "paper_state").select("source_record_id", names.corpus_id(F.element_at(F.split("source_record_id", ":"), 2)).alias("corpus"))


@query("select c corpus, row_number() over (order by length(c), c) place from (select distinct corpus_id c from paper_state)")
def sort_numeric_string(spark, folder):
    ids = table(spark, folder, "paper_state").select(F.col("corpus_id").alias("corpus")).distinct()
    return ids.select("corpus", F.row_number().over(W.orderBy(*serve.numeric_order("corpus"))).alias("place"))


@query("""
select doc_id, regexp_extract(source_url, '^(https?://[^/?#]+)', 1)
  || case when rtrim(regexp_extract(source_url, '^https?://[^/?#]+([^?#]*)', 1), '/') = '' then '/' else rtrim(regexp_extract(source_url, '^https?://[^/?#]+([^?#]*)', 1), '/') end
  || regexp_extract(source_url, '^[^?#]*([?][^#]*)?', 1) url from documents""")
def canonicalize_url(spark, folder):
    return table(spark, folder, "documents").select("doc_id", urls.canonicalize_url("source_url").alias("url"))


@query("""
with raw as (select doc_id, unnest(regexp_extract_all(text, 'https?://[^\\s<>"'']+')) u from documents where text is not null)
select distinct doc_id, case when contains(regexp_replace(u, '^https?://', ''), '/') then rtrim(rtrim(u, '.,;:!?)"]}'), '/') else rtrim(u, '.,;:!?)"]}') || '/' end url from raw
where regexp_matches(u, '^https?://[^.,;:!?)"\\]}]')""")
def extract_urls(spark, folder):
    return extract.url_relations(table(spark, folder, "documents"), "doc_id").select("doc_id", "url").distinct()


@query()
def infer_url_relation(spark, folder):
    return extract.url_relations(table(spark, folder, "documents"), "doc_id").select("doc_id", "url", "start", "end", "relation")


_ADDRESSES = [
    ("https://huggingface.co/owner/name/tree/main", "huggingface:model", "owner/name"), ("https://huggingface.co/datasets/owner/name", None, None), ("https://github.com/owner/name.git", "github:repository", "owner/name"),
    ("https://arxiv.org/abs/2401.01234v2", "arxiv", "2401.01234"), ("https://doi.org/10.5555/ABC.1", "doi", "10.5555/abc.1"), ("https://docs.example/a/b", None, None),
]


@query("select * from (values " + ", ".join(f"('{u}', {repr(n) if n else 'null'}, {repr(v) if v else 'null'})" for u, n, v in _ADDRESSES) + ") t(url, namespace, value)")
def identifier_from_url(spark, folder):
    found = spark.createDataFrame([(u,) for u, _, _ in _ADDRESSES], "url string").withColumn("i", urls.identifier_from_url(F.col("url")))
    return found.select("url", "i.namespace", "i.value")


@query()
def identifier_from_source_url(spark, folder):
    """identifier_from_url over the addresses of all documents; null where an address names no identifier."""
    return table(spark, folder, "documents").select("doc_id", urls.identifier_from_url(F.col("source_url")).alias("i")).select("doc_id", "i.namespace", "i.value")


@query("select doc_id, case when regexp_matches(text, '[.!?\\n]') then regexp_extract(text, '^([^.!?\\n]*[.!?\\n])', 1) else text end sentence from documents")
def first_sentence(spark, folder):
    return table(spark, folder, "documents").select("doc_id", text.first_sentence(F.col("text")).alias("sentence"))


@query("""
with t as (select work_row, json_each.key k, unnest(from_json(json_each.value, '["BIGINT"]')) p from source_openalex_page1, json_each(abstract_inverted_index)),
first as (select work_row, p, arg_min(k, k) k from t group by all)
select w.work_row, coalesce(string_agg(k, ' ' order by p), '') abstract from source_openalex_page1 w left join first using (work_row) group by all""")
def reconstruct_abstract(spark, folder):
    return table(spark, folder, "source_openalex_page1").select("work_row", text.reconstruct_abstract(F.col("abstract_inverted_index")).alias("abstract"))


@query("""select source_record_id, 'https://doi.org/' || (external_ids_json::json ->> 'DOI') url from paper_state where (external_ids_json::json ->> 'DOI') is not null""")
def external_id_urls(spark, folder):
    ids = table(spark, folder, "paper_state").select("source_record_id", F.explode(F.from_json("external_ids_json", "map<string,string>")).alias("scheme", "value"))
    return ids.select("source_record_id", urls.external_id_url(F.col("scheme"), F.col("value")).alias("url")).where("url is not null")


@query("select work_row, pdf_url url, '$.links.pdf' locator from source_openalex_page1 where pdf_url is not null union all select work_row, doi, '$.ids[0]' from source_openalex_page1 where doi is not null")
def json_url_walk(spark, folder):
    doc = F.to_json(F.struct(F.struct(F.col("pdf_url").alias("pdf")).alias("links"), F.array("doi").alias("ids"), F.col("title")), {"ignoreNullFields": "false"})
    found = table(spark, folder, "source_openalex_page1").select("work_row", F.explode(text.json_url_walk(doc)).alias("x"))
    return found.select("work_row", "x.url", "x.locator")


@query("select hub_row, f.rfilename file, not (f.rfilename like '/%' or contains(f.rfilename, '..')) safe from (select hub_row, unnest(siblings) f from source_huggingface_page1)")
def safe_filename(spark, folder):
    files = table(spark, folder, "source_huggingface_page1").select("hub_row", F.explode("siblings.rfilename").alias("file"))
    return files.select("hub_row", "file", names.safe_filename(F.col("file")).alias("safe"))


@query("select relation, case when relation in ('weights', 'checkpoint') then 'weights' when relation in ('code', 'official_implementation') then 'code' when relation = 'doi' then 'paper' when relation = 'model_card' then 'model' else 'resource' end category from (values ('weights'), ('checkpoint'), ('code'), ('official_implementation'), ('doi'), ('model_card'), ('license')) t(relation)")
def resource_category(spark, folder):
    rows = spark.createDataFrame([(r,) for r in ("weights", "checkpoint", "code", "official_implementation", "doi", "model_card", "license")], "relation string")
    return rows.select("relation", entries.resource_category(F.col("relation"), F.lit("other")).alias("category"))


@query("select doc_id, greatest(0, 40 - 80)::bigint start_at from documents where length(text) >= 400")
def bounded_context(spark, folder):
    long = table(spark, folder, "documents").where(F.length("text") >= 400)
    return long.select("doc_id", text.bounded_context(F.length("text"), F.lit(40), F.lit(60), 200)["start"].cast("long").alias("start_at"))


@query()
def bounded_context_mentions(spark, folder):
    """bounded_context of every URL mention of every text: start and end of the window around it."""
    documents = table(spark, folder, "documents")
    spans = extract.url_relations(documents, "doc_id").select("doc_id", "start", "end")
    sizes = documents.where("text is not null").select("doc_id", F.length("text").alias("size"))
    window = text.bounded_context(F.col("size"), F.col("start"), F.col("end"), 200)
    return spans.join(sizes, "doc_id").select("doc_id", "start", "end", "size", window["start"].cast("long").alias("context_start"), window["end"].cast("long").alias("context_end"))


# ---- replay of changes

_EDGES = """
with e as (select user_id citing, (props::json ->> 'k')::bigint cited, case when event_type = 'error' then 'delete' else 'upsert' end operation, row_number() over (order by ts, event_id) - 1 event_index from events)
"""


def _edges(spark, folder) -> DataFrame:
    changes = table(spark, folder, "events").select(
        F.col("user_id").alias("citing"), F.get_json_object("props", "$.k").cast("long").alias("cited"), F.when(F.col("event_type") == "error", "delete").otherwise("upsert").alias("operation"), "ts", "event_id"
    )
    return replay.citation_events(changes, [F.col("ts"), F.col("event_id")])


@query(_EDGES + "select * from e")
def citation_events(spark, folder):
    return _edges(spark, folder)


@query(_EDGES + "select citing, cited, arg_max(operation, event_index) = 'delete' tombstone, max(event_index) event_index from e group by all")
def citation_state(spark, folder):
    return replay.citation_state(_edges(spark, folder))


@query(_EDGES + "select citing, cited, arg_max(operation, event_index) = 'delete' tombstone, max(event_index) event_index from e group by all having arg_max(operation, event_index) <> 'delete'")
def scan_citation_active(spark, folder):
    return replay.active(replay.citation_state(_edges(spark, folder)))


@query(_EDGES + ", l as (select *, lag(operation) over (partition by citing, cited order by event_index) b from e) select citing, cited, operation, event_index from l where operation = 'delete' and coalesce(b, 'delete') = 'delete'")
def citation_rejects(spark, folder):
    return replay.citation_rejects(_edges(spark, folder))


@query("""
select d.diff_index, count(*) changes, max(operation_index) high from (select replay_order.diff_index diff_index, replay_order.operation_index operation_index from lake_records) d group by all having min(operation_index) >= 0""")
def replay_order(spark, folder):
    at = table(spark, folder, "lake_records").select(F.col("replay_order.diff_index").alias("diff_index"), F.col("replay_order.operation_index").alias("operation_index"))
    return at.groupBy("diff_index").agg(F.count("*").alias("changes"), F.max("operation_index").alias("high"), F.min("operation_index").alias("low")).where("low >= 0").drop("low")


_DIFFS = "with d as (select distinct replay_order.diff_index diff_index, replay_order.from_release from_release, replay_order.to_release to_release from lake_records)\n"


@query(_DIFFS + ", l as (select *, lag(to_release) over (order by diff_index) b from d) select diff_index, from_release, to_release from l where b <> from_release")
def replay_chain(spark, folder):
    order = F.col("replay_order")
    diffs = table(spark, folder, "lake_records").select(order["diff_index"].alias("diff_index"), order["from_release"].alias("from_release"), order["to_release"].alias("to_release")).distinct()
    last = diffs.agg(F.max("to_release").alias("release"))
    return replay.chain_breaks(diffs.crossJoin(F.broadcast(last)).withColumn("all", F.lit(0)), ["all"], "release").select("diff_index", "from_release", "to_release")


@query("with d as (select distinct l_returnflag ds, l_linenumber di, l_linestatus s from lineitem) select di diff_index, s to_release, count(distinct ds) n from d group by all having count(distinct ds) < (select count(distinct ds) from d)")
def replay_transitions_agree(spark, folder):
    d = table(spark, folder, "lineitem").select(F.col("l_returnflag").alias("dataset"), F.col("l_linenumber").alias("diff_index"), F.lit("").alias("from_release"), F.col("l_linestatus").alias("to_release")).distinct()
    return replay.transitions_disagree(d).select("diff_index", "to_release", "n")


@query("select source_record_id, replay_order.diff_index diff_index, replay_order.operation_index operation_index, content_sha256, count(*) copies from lake_records group by all")
def replay_dedupe_identical(spark, folder):
    flat = table(spark, folder, "lake_records").withColumns({"diff_index": F.col("replay_order.diff_index"), "operation_index": F.col("replay_order.operation_index")})
    return replay.dedupe_identical(flat, ["source_record_id", "diff_index", "operation_index"], ["content_sha256"])


def _diff_events(spark, folder) -> DataFrame:
    kind = F.col("event_type")
    dataset = F.when(kind.isin("signup", "error"), "papers").when(kind == "purchase", "abstracts").otherwise("paper-ids")
    operation = F.when(kind.isin("error", "click"), "delete").otherwise("upsert")
    return table(spark, folder, "events").select("user_id", dataset.alias("dataset"), operation.alias("operation"), F.col("ts").alias("transition"), "event_id", F.get_json_object("props", "$.k").alias("value")).withColumnRenamed("event_id", "position")


_STATE = """
with e as (select user_id, epoch_us(ts) tm, props::json ->> 'k' v, event_type t from events),
p as (select user_id, arg_max(t, tm) last, arg_max(v, tm) v, max(tm) filter (t = 'error') cleared from e where t in ('signup', 'error') group by all),
a as (select user_id, arg_max(v, tm) v, max(tm) tm from e where t = 'purchase' group by all),
i as (select user_id, v, arg_max(t, tm) last, max(tm) tm from e where t in ('view', 'click') group by all),
l as (select i.user_id, string_agg(i.v, ',' order by i.v) aliases from i join p using (user_id) where i.last = 'view' and (cleared is null or i.tm > cleared) group by all)
select p.user_id, last = 'error' tombstone, case when last <> 'error' then p.v end paper, case when last <> 'error' and (cleared is null or a.tm > cleared) then a.v end abstract,
       case when last <> 'error' then coalesce(aliases, '') else '' end aliases
from p left join a using (user_id) left join l using (user_id)
"""


@query(_STATE)
def replay_diff_state(spark, folder):
    return replay.replay_diff_state(_diff_events(spark, folder), "user_id").withColumn("aliases", F.array_join("aliases", ","))


@query("""
with ids as (select l_orderkey, l_orderkey || '-' || l_partkey alias from lineitem)
select o_orderkey, o_totalprice, s.shipped, coalesce(a.aliases, '') aliases from orders
left join (select l_orderkey, min(l_shipdate) shipped from lineitem group by all) s on s.l_orderkey = o_orderkey
left join (select l_orderkey, string_agg(distinct alias, ',' order by alias) aliases from ids group by all) a on a.l_orderkey = o_orderkey""")
def join_snapshot_state(spark, folder):
    papers = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    lines = table(spark, folder, "lineitem").withColumn("o_orderkey", F.col("l_orderkey"))
    abstracts = lines.groupBy("o_orderkey").agg(F.min("l_shipdate").alias("shipped"))
    aliases = lines.select("o_orderkey", F.concat_ws("-", "l_orderkey", "l_partkey").alias("alias"))
    return replay.join_snapshot_state(papers, abstracts, aliases, "o_orderkey", "alias").withColumn("aliases", F.array_join("aliases", ","))


@query("select l_partkey, count(distinct l_suppkey) owners from lineitem group by all having count(distinct l_suppkey) > 1")
def join_global_alias_owner(spark, folder):
    return replay.alias_conflicts(table(spark, folder, "lineitem"), "l_partkey", "l_suppkey")


# ---- relations

_ARTIFACTS = "with art as (select source_record_id id, (not tombstone)::int active, content_sha256 rev from paper_state), ev as (select source_record_id subject, content_sha256 rev, ingested_at from lake_records)\n"


def _artifacts(spark, folder) -> DataFrame:
    return table(spark, folder, "paper_state").select(F.col("source_record_id").alias("id"), (~F.col("tombstone")).cast("int").alias("active"), F.col("content_sha256").alias("current_revision_id"))


@query(_ARTIFACTS + "select id, rev revision from art where active = 1 and rev is not null")
def filter_current_active(spark, folder):
    return relations.current_artifacts(_artifacts(spark, folder)).select("id", F.col("current_revision_id").alias("revision"))


@query(_ARTIFACTS + "select art.id artifact_id, ev.subject, ev.ingested_at from art join ev using (rev) where active = 1")
def join_current_revision(spark, folder):
    evidence = table(spark, folder, "lake_records").select(F.col("content_sha256").alias("artifact_revision_id"), F.col("source_record_id").alias("subject"), "ingested_at")
    return relations.join_current_revision(_artifacts(spark, folder), evidence).select("artifact_id", "subject", "ingested_at")


@query("""
with d as (select distinct o_custkey rev, o_orderstatus rel from orders), e as (select o_orderkey id, o_custkey rev, o_orderstatus rel from orders where o_orderpriority like '1%')
select d.rev artifact_revision_id, d.rel relation, min(e.id) evidence_id, count(e.id) evidence_count from d left join e using (rev, rel) group by all""")
def join_discovery_evidence(spark, folder):
    o = table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("artifact_revision_id"), F.lit(1).alias("url_id"), F.col("o_orderstatus").alias("relation"), F.lit(None).cast("string").alias("locator"), "o_orderpriority")
    found = relations.join_discovery_evidence(o.drop("id", "o_orderpriority").distinct(), o.where("o_orderpriority like '1%'"))
    return found.select("artifact_revision_id", "relation", "evidence_id", "evidence_count")


_PLAIN_URL = "regexp_replace(regexp_replace(source_url, '[?#].*$', ''), '/$', '')"


@query(f"with u as (select doc_id, {_PLAIN_URL} url from documents), t as (select url, min(doc_id) target_id from u group by all) select doc_id artifact_id, url, target_id from u join t using (url) where doc_id <> target_id")
def join_url_targets(spark, folder):
    pages = table(spark, folder, "documents").select(F.col("doc_id").alias("artifact_id"), F.expr(_PLAIN_URL).alias("url"))
    owners = pages.groupBy("url").agg(F.min("artifact_id").alias("artifact_id")).withColumn("rank", F.lit(0))  # the first crawl owns a URL
    return relations.join_url_targets(pages, owners).select("artifact_id", "url", "target_id")


@query(f"with u as (select doc_id, {_PLAIN_URL} url from documents), f as (select url, min(doc_id) url_id from u group by all) select doc_id, url_id from u join f using (url)")
def join_url_ids(spark, folder):
    pages = table(spark, folder, "documents").select("doc_id", F.expr(_PLAIN_URL).alias("url"))
    frontier = pages.groupBy("url").agg(F.min("doc_id").alias("url_id"))
    return coverage.url_ids(pages, frontier).select("doc_id", "url_id")


@query("""
with a as (select s_nationkey nation, min(s_suppkey) anchor, count(*) n from supplier group by all)
select nation, anchor source_id, s_suppkey target_id from supplier join a on nation = s_nationkey where n > 1 and s_suppkey <> anchor""")
def join_identity_star(spark, folder):
    star = relations.join_identity_star(table(spark, folder, "supplier"), ["s_nationkey"], "s_suppkey", F.lit(1.0), F.col("s_name"))
    return star.select(F.col("s_nationkey").alias("nation"), "source_id", "target_id")


@query("select l_orderkey, l_linenumber, count(distinct (l_partkey, l_suppkey, l_quantity)) n from lineitem group by all having count(distinct (l_partkey, l_suppkey, l_quantity)) > 1")
def dedupe_relation(spark, folder):
    return checks.contradictions(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], F.struct("l_partkey", "l_suppkey", "l_quantity"))


@query("select relation, count(*) n from (select case when l_returnflag = 'R' then 'license' else l_returnflag end relation from lineitem) where lower(relation) <> 'license' group by all")
def filter_relation_license(spark, folder):
    links = table(spark, folder, "lineitem").select(F.when(F.col("l_returnflag") == "R", "license").otherwise(F.col("l_returnflag")).alias("relation"))
    return relations.without_license(links).groupBy("relation").agg(F.count("*").alias("n"))


@query("select user_id, arg_min(event_id, (ts, event_id)) event_id, arg_min(event_type, (ts, event_id)) event_type from events group by all")
def dedupe_first_seen(spark, folder):
    return relations.dedupe_first_seen(table(spark, folder, "events").select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("""
with p as (select * from events where event_id >= 100 order by event_id limit 2000), f as (select user_id, min(event_id) first from p group by all),
s as (select min(first) stop from (select first from f order by first offset 100 limit 1))
select event_id, user_id from p, s where stop is null or event_id < stop""")
def page_by_ordinal(spark, folder):
    return relations.page_by_ordinal(table(spark, folder, "events"), "event_id", "user_id", 100, 2000, 100).select("event_id", "user_id")


@query("""
select doc_id, c.n candidates, r.n relations from documents
left join (select l_orderkey, count(*) n from lineitem where l_returnflag = 'A' group by all) c on c.l_orderkey = doc_id
left join (select l_orderkey, count(*) n from lineitem where l_returnflag = 'R' group by all) r on r.l_orderkey = doc_id where c.n > 0 or r.n > 0""".replace("c.n candidates, r.n relations", "coalesce(c.n, 0) candidates, coalesce(r.n, 0) relations"))
def join_ordinal_merge(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn("doc_id", F.col("l_orderkey"))
    merged = relations.join_ordinal_merge(table(spark, folder, "documents").select("doc_id"), lines.where("l_returnflag = 'A'"), lines.where("l_returnflag = 'R'"), "doc_id")
    return merged.select("doc_id", "candidates", "relations")


@query("""
with i as (select distinct sha value, id from source_huggingface_page1 where sha is not null and id is not null), a as (select value, min(id) anchor, count(*) n from i group by all),
l as (select distinct id source_id, 'https://hub.example/' || b url from (select id, unnest(base_models) b from source_huggingface_page1) where b is not null), o as (select distinct 'https://hub.example/' || id url, id target_id from source_huggingface_page1),
e as (select source_id, target_id, url from l join o using (url) where source_id <> target_id)
select anchor source_id, id target_id, 'identifier' connection, 'shared' direction, 'sha' namespace, value, '' locator from i join a using (value) where n > 1 and id <> anchor
union all select source_id, target_id, 'url', 'out', 'base_model', url, '' from e union all select target_id, source_id, 'url', 'in', 'base_model', url, '' from e""")
def join_connected_artifacts(spark, folder):
    hub = table(spark, folder, "source_huggingface_page1")
    address = F.concat(F.lit("https://hub.example/"), "id").alias("url")
    identifiers = hub.where("sha is not null").select(F.col("id").alias("artifact_id"), F.lit("sha").alias("namespace"), F.col("sha").alias("value"))
    bases = hub.select(F.col("id").alias("artifact_id"), F.explode("base_models").alias("base")).where("base is not null")
    links = bases.select("artifact_id", F.concat(F.lit("https://hub.example/"), "base").alias("url"), F.lit("base_model").alias("relation"), F.lit(None).cast("string").alias("locator"))
    return relations.connected_artifacts(identifiers, links, hub.select(address, F.col("id").alias("artifact_id")))


@query("select m.id, count(distinct a.model_row) declared, count(distinct a.canonical_name) names from (select distinct id from models where status = 'released') m join models a using (id) group by all")
def join_model_declarations(spark, folder):
    models = table(spark, folder, "models")
    return coverage.model_declarations(models.where("status = 'released'"), models, "id", "model_row", "canonical_name")


@query(f"with u as (select doc_id, source, {_PLAIN_URL} url from documents), t as (select url, max(doc_id) target from u group by all) select doc_id, source, target from u left join t using (url)")
def join_export_links(spark, folder):
    pages = table(spark, folder, "documents").select("doc_id", "source", F.expr(_PLAIN_URL).alias("url"))
    return coverage.export_links(pages, pages.withColumnRenamed("doc_id", "artifact_id")).select("doc_id", "source", "target")


@query("with k as (select distinct source_record_id from paper_state where not tombstone) select distinct l.source_record_id from lake_records l semi join k using (source_record_id)")
def join_seed_resources(spark, folder):
    return coverage.seed_resources(table(spark, folder, "lake_records"), table(spark, folder, "paper_state").where("not tombstone"), "source_record_id")


@query("with f as (select source_record_id, count(*) n from lake_records where content_sha256 like '0%' group by all) select p.source_record_id, coalesce(n, 0) failures from paper_state p left join f using (source_record_id) where not tombstone and coalesce(n, 0) < 2")
def join_alphaxiv_eligible(spark, folder):
    failed = table(spark, folder, "lake_records").where("content_sha256 like '0%'")
    return coverage.eligible(table(spark, folder, "paper_state").where("not tombstone"), failed, "source_record_id", 2)


@query("""
with n as (select distinct trim(regexp_replace(lower(canonical_name), '[^a-z0-9_]+', ' ', 'g')) name from models where status = 'released')
select epoch_row, n.name is not null found from source_epoch left join n on n.name = trim(regexp_replace(lower(model), '[^a-z0-9_]+', ' ', 'g'))""")
def join_coverage(spark, folder):
    index = table(spark, folder, "models").where("status = 'released'").select(names.normalize_name("canonical_name").alias("name"))
    wanted = table(spark, folder, "source_epoch").select("epoch_row", names.normalize_name("model").alias("name"))
    return coverage.covered(wanted, index).select("epoch_row", "found")


# ---- aggregates and rankings


@query("select 'models' name, count(*) value from models union all select 'documents', count(*) from documents union all select 'released', count(*) filter (status = 'released') from models union all select 'tombstones', count(*) filter (tombstone) from paper_state union all select 'paper_state', count(*) from paper_state")
def agg_stats(spark, folder):
    tables = {t: table(spark, folder, t) for t in ("models", "documents", "paper_state")}
    return serve.agg_stats(tables, {"released": ("models", F.col("status") == "released"), "tombstones": ("paper_state", F.col("tombstone"))})


@query("select source, count(*) artifacts, count(*) filter (text is not null) active, count(distinct content_sha256) revisions from documents group by all")
def agg_coverage_metrics(spark, folder):
    return coverage.coverage_metrics(table(spark, folder, "documents"), "source", F.col("text").isNotNull(), "content_sha256")


@query("select user_id source, max(event_id) id, arg_max(event_type, event_id) status from events group by all")
def agg_source_status(spark, folder):
    return serve.agg_source_status(table(spark, folder, "events").select(F.col("user_id").alias("source"), F.col("event_id").alias("id"), F.col("event_type").alias("status")))


_NAME = "trim(regexp_replace(lower({}), '[^a-z0-9_]+', ' ', 'g'))"


@query(f"""
with e as (select source bucket, {_NAME.format('model')} n from source_epoch where model is not null), f as (select distinct {_NAME.format('model')} n, 1 hit from source_epoch where base_model is null),
j as (select bucket, coalesce(hit, 0) hit from e left join f using (n))
select bucket, count(*) total, sum(hit)::bigint found, sum(hit) / count(*) recall from j group by all union all select 'all', count(*), sum(hit)::bigint, sum(hit) / count(*) from j""")
def agg_bucket_recall(spark, folder):
    sheet = table(spark, folder, "source_epoch").where("model is not null").select(F.col("source").alias("bucket"), names.normalize_name("model").alias("normalized_name"), "base_model")
    return serve.agg_bucket_recall(sheet.drop("base_model"), sheet.where("base_model is null"))


@query(f"""
with r as (select epoch_row, model, {_NAME.format('model')} n from source_epoch where model is not null), i as (select distinct {_NAME.format('canonical_name')} n from models)
select r.n normalized_name, min(epoch_row) first_row, string_agg(distinct model, '|' order by model) spellings, count(*) "rows", bool_or(i.n is not null) found from r left join i using (n) group by all""")
def agg_benchmark_recall(spark, folder):
    rows = table(spark, folder, "source_epoch").where("model is not null").select(F.col("epoch_row").alias("row"), F.col("model").alias("name"), names.normalize_name("model").alias("normalized_name"))
    index = table(spark, folder, "models").where("canonical_name is not null").select(names.normalize_name("canonical_name").alias("normalized_name"))
    return serve.agg_benchmark(rows, index).withColumn("spellings", F.array_join("spellings", "|"))


@query("""
with a as (select source, count(*) artifacts, count(*) filter (n > 0) candidates, coalesce(sum(n), 0)::bigint claims from (select distinct source, doc_id from documents) d left join (select l_orderkey doc_id, count(*) n from lineitem group by all) c using (doc_id) group by all),
s as (select source, zone_name <> 'UTC' enabled from source_settings), k as (select source, max(epoch_row) % 2 = 0 complete from source_epoch where source is not null group by all)
select source, coalesce(artifacts, 0) artifacts, coalesce(candidates, 0) candidates, coalesce(claims, 0) claims, s.enabled is not null configured, coalesce(enabled, false) enabled, complete is not null observed, coalesce(complete, false) complete,
  coalesce(artifacts, 0) > 0 has_artifacts, coalesce(claims, 0) > 0 has_claims, coalesce(enabled and complete and artifacts > 0 and claims > 0, false) ready
from s full join k using (source) full join a using (source)""")
def agg_readiness(spark, folder):
    configured = table(spark, folder, "source_settings").select("source", (F.col("zone_name") != "UTC").alias("enabled"))
    checkpoints = table(spark, folder, "source_epoch").where("source is not null").groupBy("source").agg((F.max("epoch_row") % 2 == 0).alias("complete"))
    claims = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("artifact_id"))
    return coverage.readiness(configured, checkpoints, table(spark, folder, "documents").select("source", F.col("doc_id").alias("artifact_id")), claims)


@query("select event_type evidence_type, count(*) n from events group by all")
def agg_relation_counts(spark, folder):
    return coverage.relation_counts(table(spark, folder, "events"), "event_type")


@query("""
with f as (select sha, f.rfilename file from (select sha, unnest(siblings) f from source_huggingface_page1))
select sha release_id, string_agg(distinct file, '|' order by file) files, true complete from f group by all""")
def agg_release_weights(spark, folder):
    files = table(spark, folder, "source_huggingface_page1").select(F.col("sha").alias("release_id"), F.explode("siblings.rfilename").alias("file"))
    checked = files.withColumns({"safe": names.safe_filename(F.col("file")), "complete": F.lit(True)})
    return serve.agg_release_weights(checked).withColumn("files", F.array_join("files", "|"))


@query("with o as (select source, count(*) n from documents group by all) select source, s.source is not null configured, o.source is not null observed, coalesce(n, 0) records from (select source from source_settings union select source from documents) x left join source_settings s using (source) left join o using (source)")
def agg_source_manifest(spark, folder):
    observed = table(spark, folder, "documents").groupBy("source").agg(F.count("*").alias("records"))
    return serve.agg_source_manifest(table(spark, folder, "source_settings"), observed)


@query("select count(*) documents, count(*) filter (text like '%http%') with_urls, count(distinct source) sources from documents")
def agg_projection_stats(spark, folder):
    return coverage.projection_stats(table(spark, folder, "documents"), {"with_urls": F.col("text").like("%http%")})


@query("select replay_order.to_release release, count(distinct replay_order.diff_index) shards, count(*) \"rows\" from lake_records where replay_order.to_release is not null group by all union all select 'all', count(distinct replay_order.diff_index), count(*) from lake_records")
def agg_lake_status(spark, folder):
    lake = table(spark, folder, "lake_records").select(F.col("replay_order.to_release").alias("release"), F.col("replay_order.diff_index").alias("diff"))
    return coverage.lake_status(lake, "release", "diff")


_RANK = "case status when 'stub' then 0 when 'candidate' then 1 when 'documented' then 2 when 'released' then 3 end"


@query(f"select id, arg_max(status, {_RANK}) status, max(confidence) filter (not isnan(confidence)) confidence from models where id is not null group by all")
def agg_status_merge(spark, folder):
    hints = table(spark, folder, "models").where("id is not null").withColumn("confidence", F.when(~F.isnan("confidence"), F.col("confidence")))
    return store.status_merge(hints, "id")


@query("""
with recursive l as (select model_row n, 'i' || id a from models where id is not null union select model_row, 'n' || canonical_name || coalesce(organization, '') from models where canonical_name is not null),
e as (select distinct x.n a, y.n b from l x join l y using (a)),
r(n, c) as (select n, n from (select distinct n from l) union select e.b, r.c from r join e on e.a = r.n where e.b >= r.c)
select n node, min(c) component from r group by all""")
def components_entries(spark, folder):
    models = table(spark, folder, "models")
    by_id = models.where("id is not null").select(F.col("model_row").alias("node"), F.concat(F.lit("i"), "id").alias("anchor"))
    by_name = models.where("canonical_name is not null").select(F.col("model_row").alias("node"), F.concat(F.lit("n"), "canonical_name", F.coalesce("organization", F.lit(""))).alias("anchor"))
    return entries.components(by_id.unionByName(by_name))


@query(f"""
with c as (select *, {_NAME.format('canonical_name')} nn from models where canonical_name is not null and id is not null)
select id component, arg_min(canonical_name, (nn, canonical_name, source, model_row)) canonical_name, string_agg(distinct canonical_name, '|' order by canonical_name) aliases, count(*) members from c group by all""")
def agg_entry_merge(spark, folder):
    c = table(spark, folder, "models").where("canonical_name is not null and id is not null").select(
        F.col("id").alias("component"), F.col("canonical_name").alias("name"), names.normalize_name("canonical_name").alias("normalized_name"), "source", F.format_string("%09d", "model_row").alias("source_record_id"),
        F.lit("").alias("local_id"), F.array("id").alias("identifiers"),
    )
    merged = entries.agg_entry_merge(c)
    return merged.select("component", "canonical_name", F.array_join("aliases", "|").alias("aliases"), "members")


@query("""select id, 'entry:' || sha256('{"anchors":["' || id || '"]}') entry from (select distinct id from models where id is not null)""")
def entry_id(spark, folder):
    return table(spark, folder, "models").where("id is not null").select("id").distinct().select("id", entries.entry_id(F.array("id")).alias("entry"))


def _seeds(spark, folder) -> DataFrame:
    hub = table(spark, folder, "source_huggingface_page1")
    link = "struct<url:string,relation:string,model_local_ids:array<string>>"
    paper = F.when(F.col("card_data.paper").isNotNull(), F.array(F.struct(F.col("card_data.paper").alias("url"), F.lit("paper").alias("relation"), F.array().cast("array<string>").alias("model_local_ids"))))
    model = F.struct(F.lit("m").alias("local_id"), F.col("id").alias("name"), F.array("pipeline_tag").alias("tags"), F.array(F.concat(F.lit("hub:"), "id")).alias("identifiers"))
    return hub.select(
        "source", F.col("hub_row").cast("string").alias("source_record_id"), F.lit("model_card").alias("kind"), F.concat(F.lit("https://hub.example/"), "id").alias("canonical_url"),
        F.coalesce("tags", F.array().cast("array<string>")).alias("tags"), F.array(model).alias("models"), F.coalesce(paper, F.array().cast(f"array<{link}>")).alias("links"),
    )


@query("select hub_row::varchar source_record_id, id \"name\", 1 + (card_data.paper is not null)::int resources from source_huggingface_page1")
def entry_candidates(spark, folder):
    return entries.entry_candidates(_seeds(spark, folder)).select("source_record_id", "name", F.size("resources").alias("resources"))


@query("select hub_row::varchar source_record_id, 0 step, 'fetch' action, 'https://hub.example/' || id url from source_huggingface_page1 union all select hub_row::varchar, 1, 'fetch', card_data.paper from source_huggingface_page1 where card_data.paper is not null")
def entry_plan(spark, folder):
    return entries.entry_plan(entries.entry_candidates(_seeds(spark, folder))).select("source_record_id", "step", "action", "url")


@query(f"with k as (select {_PLAIN_URL} url, doc_id from documents), o as (select url, min(doc_id) owner from k group by all having count(distinct doc_id) = 1) select distinct user_id source_id, owner target_id from events join (select owner, row_number() over (order by owner) n from o) x on x.n = user_id where user_id <> owner")
def join_citations_closed(spark, folder):
    pages = table(spark, folder, "documents").select(F.expr(_PLAIN_URL).alias("key"), F.col("doc_id").alias("entry"))
    owned = entries.unique_owner(pages, ["key"], "entry").select("key", F.row_number().over(W.orderBy("entry")).alias("n"))
    links = table(spark, folder, "events").select(F.col("user_id").alias("entry"), F.lit("cites").alias("predicate"), F.lit(None).cast("string").alias("direction")).join(owned, F.col("entry") == F.col("n")).drop("n")
    return entries.citations_closed(links, pages)


@query("with c as (select id identifier, model_row candidate from models where status = 'released'), p as (select m.model_row record, c.candidate from models m join c on c.identifier = m.id where m.model_row <> c.candidate) select record, min(candidate) candidate from p group by all having count(distinct candidate) = 1")
def join_evidence_attach(spark, folder):
    models = table(spark, folder, "models")
    evidence = models.select(F.col("model_row").alias("record"), F.col("id").alias("identifier"), F.lit("u").alias("url"), F.lit("weights").alias("relation"))
    owners = models.where("status = 'released'").select(F.col("id").alias("identifier"), F.col("model_row").alias("candidate"), F.col("model_row").alias("record"))
    return entries.evidence_attach(evidence, owners).select("record", "candidate")


@query("with u as (select id identifier, min(model_row) entry from models where id is not null group by all having count(distinct model_row) = 1) select m.model_row record, coalesce(case when m.status = 'released' then m.model_row end, u.entry) target_entry from models m left join u on u.identifier = m.id")
def join_model_relation_target(spark, folder):
    models = table(spark, folder, "models")
    relations_ = models.select(F.col("model_row").alias("record"), F.lit("x").alias("target_local_id"), F.col("id").alias("target_identifier"))
    members = models.where("status = 'released'").select(F.col("model_row").alias("record"), F.lit("x").alias("local_id"), F.col("model_row").alias("entry"))
    ids = models.where("id is not null").select(F.col("id").alias("identifier"), F.col("model_row").alias("entry"))
    return entries.model_relation_target(relations_, members, ids).select("record", "target_entry")


@query(f"""
with m as (select id, canonical_name, {_NAME.format('canonical_name')} n, coalesce(confidence, 0) c from models where id is not null and canonical_name is not null and not isnan(coalesce(confidence, 0))),
r as (select *, case when n = 'model' then 0 when n like 'model%' then 1 when lower(id) like '%model%' then 0 when n like '%model%' then 2 end rank from m),
b as (select id, arg_min(canonical_name, (rank, canonical_name, c)) "name", arg_min(c, (rank, canonical_name, c)) confidence, min(rank) rank from r where rank is not null group by all)
select * from b order by rank, confidence desc, "name", id limit 50""")
def topk_search(spark, folder):
    models = table(spark, folder, "models").where("id is not null and canonical_name is not null and not isnan(coalesce(confidence, 0))")
    shaped = models.select("id", F.col("canonical_name").alias("name"), names.normalize_name("canonical_name").alias("normalized_name"), F.col("id").alias("identifier"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"))
    return serve.topk_search(shaped, "model")


_FRONTIER = """
with f as (select event_id::varchar url, case event_type when 'view' then 'pending' when 'click' then 'claimed' when 'error' then 'failed' else 'done' end status, (event_id % 5)::int attempts, ts first_seen_at,
  case when event_type <> 'view' then ts + interval 1 hour end last_fetched_at, case when event_type = 'click' then ts + interval 2 hour end claimed_at from events)
"""
_NOW = "2024-06-01 00:00:00"


def _frontier(spark, folder) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("url"), F.when(kind == "view", "pending").when(kind == "click", "claimed").when(kind == "error", "failed").otherwise("done").alias("status"), (F.col("event_id") % 5).cast("int").alias("attempts"),
        F.col("ts").alias("first_seen_at"), F.when(kind != "view", F.col("ts") + F.expr("interval 1 hour")).alias("last_fetched_at"), F.when(kind == "click", F.col("ts") + F.expr("interval 2 hour")).alias("claimed_at"),
    )


@query(_FRONTIER + f"""select url, 'claimed' status, attempts + 1 attempts from f where status = 'pending' or (status in ('done', 'failed') and last_fetched_at <= timestamp '{_NOW}' - interval 1 day)
  or (status = 'claimed' and claimed_at <= timestamp '{_NOW}' - interval 1 hour) order by last_fetched_at is not null, first_seen_at, url limit 200""")
def topk_frontier_claim(spark, folder):
    now = F.lit(_NOW).cast(dict(table(spark, folder, "events").dtypes)["ts"])
    return serve.topk_frontier_claim(_frontier(spark, folder), now, 200).select("url", "status", "attempts")


@query(_FRONTIER + "select url, first_seen_at from f where status = 'pending' order by first_seen_at, url limit 100")
def topk_frontier_list(spark, folder):
    return serve.topk_by_status(_frontier(spark, folder), "pending", ["first_seen_at", "url"], 100).select("url", "first_seen_at")


@query("select event_id, user_id from events where event_type = 'error' order by ts, event_id limit 1000")
def topk_dead_letters(spark, folder):
    return serve.topk_by_status(table(spark, folder, "events"), "error", ["ts", "event_id"], 1000, "event_type").select("event_id", "user_id")


@query("""
with d as (select 'https://hub.example/' || id || '/' || f.rfilename url, last_modified seen from (select id, last_modified, unnest(siblings) f from source_huggingface_page1)),
g as (select url, min(seen) seen from d where regexp_matches(url, '(?i)\\.(safetensors|bin|gguf|pt|pth|ckpt|onnx|h5)$') group by all)
select url from g where url not in (select 'https://hub.example/' || id || '/weights.safetensors' from source_huggingface_page1 where hub_row % 2 = 0) order by seen, url limit 100""")
def topk_frontier_promote(spark, folder):
    hub = table(spark, folder, "source_huggingface_page1")
    base = F.concat(F.lit("https://hub.example/"), "id", F.lit("/"))
    found = hub.select(base.alias("base"), F.col("last_modified").alias("first_seen_at"), F.explode("siblings.rfilename").alias("file")).select(F.concat("base", "file").alias("url"), F.lit("weights").alias("relation"), F.lit("$.siblings").alias("locator"), "first_seen_at")
    held = hub.where("hub_row % 2 = 0").select(F.concat(base, F.lit("weights.safetensors")).alias("url"))
    return serve.topk_frontier_promote(found, held, 100)


@query("select doc_id, case when regexp_extract(source_url, '^https?://([^/:?#]+)', 1) = 'peke.invalid' then 'ignore' else 'fetch' end action from documents")
def frontier_policy(spark, folder):
    return serve.frontier_policy(table(spark, folder, "documents").select("doc_id", F.col("source_url").alias("url"), F.lit(1).alias("depth")), ["peke.invalid"], 3).select("doc_id", "action")


@query("select * from (select id, canonical_name, status from models where status = 'stub') order by id nulls first, canonical_name nulls first, status nulls first")
def sort_export(spark, folder):
    return serve.sort_export(table(spark, folder, "models").where("status = 'stub'").select("id", "canonical_name", "status"))


@query("select * from models order by all nulls first")
def sort_export_models(spark, folder):
    """sort_export of the whole table, every row and field."""
    return serve.sort_export(table(spark, folder, "models"))


@query("select source from source_settings union select source from documents union select source from models")
def set_union(spark, folder):
    return coverage.union_of(*[table(spark, folder, t).select("source") for t in ("source_settings", "documents", "models")])


@query("select replay_order.to_release release from lake_records intersect select to_release from paper_state")
def set_intersect(spark, folder):
    return coverage.intersection_of(table(spark, folder, "lake_records").select(F.col("replay_order.to_release").alias("release")), table(spark, folder, "paper_state").select(F.col("to_release").alias("release")))


@query("select distinct source_record_id from lake_records except select source_record_id from paper_state")
def set_except(spark, folder):
    return coverage.difference_of(table(spark, folder, "lake_records").select("source_record_id"), table(spark, folder, "paper_state").select("source_record_id"))


# ---- store


@query("select c_custkey from customer where c_custkey % 10 <> 3 and not exists (select 1 from (select c_custkey k from customer where c_custkey % 7 <> 0 and c_custkey % 10 <> 3) s where s.k = c_custkey)")
def antijoin_snapshot_tombstone(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey").where("c_custkey % 10 <> 3")
    return store.snapshot_tombstones(customers, customers.where("c_custkey % 7 <> 0"), "c_custkey")


@query("select c_custkey from customer where not exists (select 1 from (select c_custkey k from customer where c_custkey % 7 <> 0) s where s.k = c_custkey)")
def antijoin_snapshot_customers(spark, folder):
    """antijoin_snapshot_tombstone with all customers as the active side; only the snapshot is made up."""
    customers = table(spark, folder, "customer").select("c_custkey")
    return store.snapshot_tombstones(customers, customers.where("c_custkey % 7 <> 0"), "c_custkey")


@query("with r as (select distinct source_record_id a, sha256(payload_json) h from lake_records), k as (select source_record_id a, content_sha256 h from paper_state) select a artifact_id, h revision_hash from k union select a, h from r")
def revision_upsert(spark, folder):
    state = table(spark, folder, "paper_state").select(F.col("source_record_id").alias("artifact_id"), F.col("content_sha256").alias("revision_hash"))
    known = state.select(names.stable_id("revision", F.col("artifact_id"), F.col("revision_hash")).alias("id"), "artifact_id", "revision_hash")
    records = table(spark, folder, "lake_records").select(F.col("source_record_id").alias("artifact_id"), F.col("payload_json").alias("content"))
    return store.revision_upsert(known, records).select("artifact_id", "revision_hash")


@query("select model_row, id rev, 'old' v from models where id is not null and id not in (select id from models where status = 'released' and id is not null) union all select model_row, id, 'new' from models where status = 'released' and id is not null")
def prune_derived(spark, folder):
    rows = table(spark, folder, "models").where("id is not null").select("model_row", F.col("id").alias("rev"), F.lit("x").alias("extractor"), F.lit("old").alias("v"), "status")
    fresh = rows.where("status = 'released'").withColumn("v", F.lit("new"))
    return store.prune_derived(rows.drop("status"), fresh.drop("status"), "rev").select("model_row", "rev", "v")


@query("""
with bound as (select distinct id i, canonical_name m from models where status = 'released' and id is not null and canonical_name is not null), n as (select i, count(distinct m) n from bound group by all)
select model_row, case when id is null then 'source_scoped' when n = 1 then 'exact_identifier' when n > 1 then 'identifier_conflict' else 'exact_identifier_new' end resolution_status from models left join n on n.i = id""")
def resolve_model(spark, folder):
    models = table(spark, folder, "models")
    hints = models.select(F.col("model_row").cast("string").alias("artifact_id"), F.lit("m").alias("local_id"), F.when(F.col("id").isNotNull(), F.array(F.concat(F.lit("reg:"), "id"))).otherwise(F.array().cast("array<string>")).alias("identifiers"), "model_row")
    claims = models.where("status = 'released' and id is not null and canonical_name is not null").select(
        F.col("model_row").cast("string").alias("artifact_revision_id"), F.lit("reg").alias("namespace"), F.col("id").alias("value"), F.col("canonical_name").alias("model_id"), F.lit("bound").alias("resolution_status")
    )
    artifacts = models.select(F.lit(1).alias("active"), F.col("model_row").cast("string").alias("current_revision_id"))
    return store.resolve_model(hints, claims, artifacts).select("model_row", "resolution_status")


@query("""
with r as (select sha, min(id) owner from source_huggingface_page1 group by all) select hub_row, case when r.owner = h.id then 'exact_identifier' else 'identifier_conflict' end resolution_status from source_huggingface_page1 h join r using (sha)""")
def resolve_release(spark, folder):
    hub = table(spark, folder, "source_huggingface_page1")
    bound = hub.groupBy(F.col("sha").alias("identifier")).agg(F.min("id").alias("model_id")).withColumn("release_id", F.col("identifier"))
    hints = hub.select("hub_row", F.col("id").alias("model_id"), F.col("sha").alias("identifier"), F.lit(None).cast("string").alias("version"), F.lit(None).cast("string").alias("revision"))
    return store.resolve_release(hints, bound).select("hub_row", "resolution_status")


@query("""
with b as (select lower(id) i, count(distinct hub_row) n from source_huggingface_page1 group by all), t as (select hub_row, id, base_models[1] t from source_huggingface_page1 where len(base_models) = 1 and base_models[1] is not null)
select hub_row, case when n > 1 then 'conflicting_target_identifiers' when n = 1 then 'resolved' else 'unresolved_target' end resolution_status from t left join b on b.i = t.t""")
def resolve_relation(spark, folder):
    hub = table(spark, folder, "source_huggingface_page1")
    wanted = hub.where("size(base_models) = 1 and base_models[0] is not null").select("hub_row", F.col("hub_row").cast("string").alias("record"), F.lit("m").alias("subject_local_id"), F.col("base_models").alias("target_identifiers"))
    subjects = wanted.select("record", F.lit("m").alias("local_id"), F.col("record").alias("model_id"))
    bound = hub.select(F.lower("id").alias("identifier"), F.col("hub_row").alias("model_id"))
    return store.resolve_relation(wanted, subjects, bound).select("hub_row", "resolution_status")


@query("select doc_id, case when coalesce(source_url, '') = '' or coalesce(text, '') = '' then 'missing text' else 'ok' end issue from documents")
def validate_record(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id", "source_url", "text")
    rules = {"missing text": (F.col("source_url") != "") & (F.col("text") != "")}
    bad = checks.flagged(rows, rules).select("doc_id", "issue")
    return rows.select("doc_id").join(bad, "doc_id", "left").fillna("ok", ["issue"])


@query("select source_record_id, 1 attempts from documents where text is null")
def quarantine(spark, folder):
    bad = table(spark, folder, "documents").where("text is null").select("source_record_id", F.lit("no text").alias("issue"))
    empty = spark.createDataFrame([], "source string, source_record_id string, stage string, error string, attempts long, first_seen_at string, last_seen_at string, run_id int")
    return store.quarantine(bad, empty, "web", "ingest", 1, "2026-01-01").groupBy("source_record_id").agg(F.count("*").cast("int").alias("attempts"))


@query(f"with u as (select {_PLAIN_URL} url from documents) select url, 0 depth from u group by all")
def text_url_persist(spark, folder):
    pages = table(spark, folder, "documents").select(F.expr(_PLAIN_URL).alias("url"), F.lit("reference").alias("relation"), F.lit(False).alias("mentioned"), F.lit("").alias("own_url"))
    return store.persist_links(pages, spark.createDataFrame([], "url string, depth int"), 0)


@query("select id, string_agg(distinct canonical_name, '|' order by canonical_name) aliases from models where id = (select min(id) from models) group by all")
def model_detail(spark, folder):
    models = table(spark, folder, "models").where("id is not null")
    first = models.agg(F.min("id")).first()[0]
    aliases = models.select(F.col("id").alias("model_id"), F.col("canonical_name").alias("alias"))
    none = models.limit(0).select(F.col("id").alias("model_id"), F.lit("").alias("namespace"), F.lit("").alias("value"), F.lit("").alias("artifact_id"), "status")
    found = serve.model_detail(first, models.select("id").distinct(), aliases, none, none)
    return found.select("id", F.array_join("aliases", "|").alias("aliases"))


@query("select sha release_id, count(distinct id) models, min(last_modified) first_seen from source_huggingface_page1 group by all")
def model_releases_detail(spark, folder):
    return coverage.releases_of_model(table(spark, folder, "source_huggingface_page1"), "sha", "id", "last_modified")


@query("with c as (select source_record_id k, content_sha256 h from paper_state) select distinct l.source_record_id, l.content_sha256 from lake_records l where not exists (select 1 from c where c.k = l.source_record_id and c.h = l.content_sha256)")
def late_data(spark, folder):
    from ..streaming.microbatch import late_data as late

    return late(table(spark, folder, "paper_state"), table(spark, folder, "lake_records"), "source_record_id", "content_sha256").select("source_record_id", "content_sha256")


@query()
def extract_intro_cues(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", F.lit("Neural network cards").alias("title"), "text", F.lit("model_card").alias("kind"))
    return extract.extract_intro_cues(documents, "doc_id")


@query()
def candidates_s2(spark, folder):
    abstract = F.coalesce(F.get_json_object("raw_payload_json", "$.abstract"), F.get_json_object("raw_payload_json", "$.title"), "title")
    papers = table(spark, folder, "paper_state").where("not tombstone").select("source_record_id", F.concat(F.lit("Neural network "), F.coalesce("title", F.lit(""))).alias("title"), abstract.alias("text"), F.lit("model_card").alias("kind"))
    found = extract.extract_intro_cues(papers, "source_record_id")
    return found.withColumn("id", names.stable_id("candidate", F.col("source_record_id"), F.col("locator"), F.col("normalized_name")))
