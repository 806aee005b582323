import json
import os

import pytest
from pyspark.sql import functions as F

from lodestrata.operators import coverage, discovery, exports, relations, serve, store
from lodestrata.operators.checks import Violation
from lodestrata.sources import lake

LINK = "array<struct<model_local_ids:array<string>,relation:string,url:string>>"


def test_links_sorted(spark):
    df = spark.createDataFrame([([(None, "b", "u2"), (["m"], "a", "u1"), (None, "b", "u2")],), ([],), (None,)], f"links {LINK}")
    assert [r[0] for r in df.select(exports.links_sorted(F.col("links"))).collect()] == [
        ['{"model_local_ids":["m"],"relation":"a","url":"u1"}', '{"model_local_ids":null,"relation":"b","url":"u2"}'], [], [],
    ]


def registry(spark):
    artifacts = spark.createDataFrame(
        [("a1", "s", "r1", "paper", "https://x.test/1", "One", 1, "v1"), ("a2", "s", "r2", "paper", "https://x.test/2", "Two", 0, "v2"), ("a3", "t", "r1", "model_card", "https://x.test/3", "Three", 1, "v3")],
        "artifact_id string, source string, source_record_id string, kind string, canonical_url string, title string, active int, current_revision_id string",
    )
    declared = spark.createDataFrame([("v1", "m", "Alpha"), ("v1", "n", "Beta"), ("v1", "m", "Alpha"), ("v2", "m", "Old"), ("v0", "m", "Older")], "artifact_revision_id string, local_id string, name string")
    links = spark.createDataFrame(
        [("v1", "https://w.test/a", "weights", ["m"]), ("v1", "https://w.test/b", "code", None), ("v1", "https://w.test/c", "code", ["other"]), ("v0", "https://w.test/d", "code", None)],
        "artifact_revision_id string, url string, relation string, model_local_ids array<string>",
    )
    return artifacts, declared, links


def test_seeds(spark, tmp_path):
    seeds = exports.seeds_of(*registry(spark))
    rows = seeds.collect()
    assert [(r["source"], r["source_record_id"], [m["name"] for m in r["models"]], [json.loads(x)["url"] for x in r["links"]]) for r in rows] == [("s", "r1", ["Alpha", "Beta"], ["https://w.test/a", "https://w.test/b"])]
    receipt = exports.seed_export(seeds, f"{tmp_path}/seeds")
    assert receipt["rows"] == 1 and len(receipt["sha256"]) == 64 and receipt == exports.seed_export(seeds, f"{tmp_path}/again") | {"files": receipt["files"]}
    with pytest.raises(Exception, match="exist"):
        exports.seed_export(seeds, f"{tmp_path}/seeds")
    assert exports.seed_export(seeds, f"{tmp_path}/none", ["x"])["rows"] == 0
    with pytest.raises(Violation):
        exports.seed_export(seeds.union(seeds), f"{tmp_path}/twice")
    artifacts, declared, links = registry(spark)
    with pytest.raises(Violation):
        exports.seeds_of(artifacts.union(artifacts), declared, links)


def test_public_tables(spark, tmp_path):
    artifacts, declared, _ = registry(spark)
    tables = {"artifacts": artifacts.withColumn("raw_json", F.lit("{}")), "models": declared}
    columns = {"artifacts": ["artifact_id", "title"], "models": ["name"]}
    sources = spark.createDataFrame([("s", True), ("t", False)], "source string, enabled boolean")
    receipt = exports.metadata_export(tables, columns, sources, f"{tmp_path}/out", "Registry")
    assert {n: t["rows"] for n, t in receipt["tables"].items()} == {"artifacts": 3, "models": 5} and spark.read.parquet(f"{tmp_path}/out/artifacts.parquet").columns == ["artifact_id", "title"]
    assert json.load(open(f"{tmp_path}/out/receipt.json"))["digest"] == receipt["digest"] and "| models | 5 | name |" in open(f"{tmp_path}/out/README.md").read()
    for bad in ({"artifacts": ["raw_json"]}, {"artifacts": ["nothing"]}, {"none": ["x"]}):
        with pytest.raises(Violation):
            exports.public_projection(tables, bad)
    with pytest.raises(Exception, match="exist"):
        exports.metadata_export(tables, columns, sources, f"{tmp_path}/out", "Registry")


def test_bundle_of_one_commit(spark, tmp_path):
    root = f"{tmp_path}/store"
    df = spark.createDataFrame([(1,)], "id int")
    head = lambda: (store.read_head(root) or {}).get("commit")
    with pytest.raises(Violation):
        exports.dataset_bundle(head, {}, spark, f"{tmp_path}/b0")
    store.sink_commit({"t": df}, root)
    made = exports.dataset_bundle(head, {"seeds": lambda: {"rows": 1}}, spark, f"{tmp_path}/b1")
    assert made["commit"] == head() and os.path.exists(f"{tmp_path}/b1/bundle.json")
    with pytest.raises(Violation):
        exports.dataset_bundle(head, {"seeds": lambda: store.sink_commit({"t": df.union(df)}, root)}, spark, f"{tmp_path}/b2")
    assert not os.path.exists(f"{tmp_path}/b2/bundle.json")


def test_head_moves_only_from_its_parent(spark, tmp_path):
    root = str(tmp_path)
    first = store.sink_commit({"t": spark.range(1)}, root)
    open(f"{root}/HEAD.mine", "w").write(json.dumps(first | {"commit": "mine"}))
    with pytest.raises(Violation, match="moved"):
        store._move_head(root, "mine", "older")
    open(f"{root}/HEAD.lock", "w").close()
    open(f"{root}/HEAD.mine", "w").write("{}")
    with pytest.raises(Violation, match="being made"):
        store._move_head(root, "mine", first["commit"])
    assert store.read_head(root)["commit"] == first["commit"] and not os.path.exists(f"{root}/HEAD.mine")


def test_discovery_and_papers(spark):
    text = "We introduce DuneNet-4, a deep neural network. The source code is available at https://c.test/x for all."
    rows = [("d1", "s", "https://p.test/1", "A", text, "paper"), ("d2", "s", None, None, None, None), (None, "s", None, None, text, "paper"), ("d3", "s", "https://p.test/3", "B", text, "paper")]
    docs = spark.createDataFrame(rows, "document_id string, source string, source_url string, title string, text string, kind string")
    made = discovery.wet_discovery(docs)
    assert made.documents.count() == 3 and "text" not in made.documents.columns
    assert {(r["document_id"], r["name"]) for r in made.model_candidates.collect()} == {("d1", "DuneNet-4"), ("d3", "DuneNet-4")} and made.model_candidates.select("candidate_id").distinct().count() == 2
    assert {(r["document_id"], r["url"], r["relation"]) for r in made.url_relations.collect()} == {(k, "https://c.test/x", "implementation") for k in ("d1", "d3")}
    declared = spark.createDataFrame([("d3", "Other", "other", 1.0, "raw")], "document_id string, name string, normalized_name string, confidence double, locator string")
    links = spark.createDataFrame([("d1", "https://c.test/x", "code")], "document_id string, url string, relation string")
    ready = discovery.paper_prepare(docs.where("document_id is not null"), declared, links, "document_id")
    assert {(r["document_id"], r["name"]) for r in ready.models.collect()} == {("d1", "DuneNet-4"), ("d3", "Other")}
    assert {tuple(r) for r in ready.links.collect()} == {("d1", "https://c.test/x", "code"), ("d3", "https://c.test/x", "implementation")}


def seal(dataset, mode="diff", index=0, one="r1", two="r2", digest=None):
    return (dataset, "r3", mode, digest or dataset, index, one, two)


def test_projection_plan(spark):
    frame = lambda *rows: spark.createDataFrame(list(rows), "dataset string, release string, mode string, digest string, diff_index int, from_release string, to_release string")
    chain = [seal(d, index=i, one=f"r{i + 1}", two=f"r{i + 2}") for d in ("p", "q") for i in (0, 1)]
    plan = lake.projection_plan(frame(*chain), "r3", {"p", "q"})
    assert plan["mode"] == "diff" and plan["base_release"] == "r1" and plan["transitions"] == [(0, "r1", "r2"), (1, "r2", "r3")]
    assert lake.projection_plan(frame(seal("p", "snapshot"), seal("q", "snapshot")), "r3", {"p", "q"})["base_release"] is None
    for bad in (chain[:2], [*chain[:2], seal("q", "snapshot")], [*chain[:3]], [*chain, seal("p", digest="other")], [seal("p", index=1, one="r2", two="r4"), seal("q", index=1, one="r2", two="r4")]):
        with pytest.raises(Violation):
            lake.projection_plan(frame(*bad), "r3", {"p", "q"})


def test_connections_and_control_records(spark):
    ids = spark.createDataFrame([("a", "doi", "1"), ("b", "doi", "1"), ("c", "doi", "1"), ("a", "arxiv", "1"), (None, "doi", "1")], "artifact_id string, namespace string, value string")
    links = spark.createDataFrame([("a", "u:d", "code", "x"), ("a", "u:d", "code", "x"), ("d", "u:d", "self", None), ("b", "u:none", "code", None)], "artifact_id string, url string, relation string, locator string")
    addresses = spark.createDataFrame([("u:d", "d")], "url string, artifact_id string")
    edges = relations.connected_artifacts(ids, links, addresses)
    assert {(r["source_id"], r["target_id"], r["direction"]) for r in edges.collect()} == {("a", "b", "shared"), ("a", "c", "shared"), ("a", "d", "out"), ("d", "a", "in")} and edges.count() == 4
    assert {r["artifact_id"]: r["links"] for r in relations.artifact_classes(edges).collect()} == {"a": 3, "d": 1}
    artifacts = spark.createDataFrame([("x", "s", "r2", "catalog_record", 1, "v2"), ("y", "s", "r1", "catalog_record", 1, "v1"), ("z", "s", "r0", "catalog_record", 0, "v0")], "id string, source string, source_record_id string, kind string, active int, current_revision_id string")
    revisions = spark.createDataFrame([("v0", '{"record_type":"t"}'), ("v1", '{"record_type":"t"}'), ("v2", '{"record_type":"t"}'), ("v3", "bad")], "id string, raw_json string")
    assert [r[0] for r in relations.control_records(artifacts, revisions, "s", "t", 1).collect()] == ["r1"] and relations.control_records(artifacts, revisions, "s", "u", 5).count() == 0


def test_readiness_and_limits(spark):
    configured = spark.createDataFrame([("s", True), ("t", True), ("u", False)], "source string, enabled boolean")
    checkpoints = spark.createDataFrame([("s", True), ("t", False)], "source string, complete boolean")
    artifacts = spark.createDataFrame([("s", 1), ("s", 2), ("v", 3)], "source string, artifact_id int")
    claims = spark.createDataFrame([(1,), (1,), (3,)], "artifact_id int")
    rows = {r["source"]: r for r in coverage.readiness(configured, checkpoints, artifacts, claims).collect()}
    assert {s: r["ready"] for s, r in rows.items()} == {"s": True, "t": False, "u": False, "v": False} and (rows["s"]["artifacts"], rows["s"]["candidates"], rows["s"]["claims"]) == (2, 1, 2)
    with pytest.raises(ValueError):
        serve.topk_by_status(configured, None, ["source"], 10**6)
