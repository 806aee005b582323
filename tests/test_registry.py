"""Every query with an oracle against DuckDB on the smallest data, and cases that the data lack."""

import glob
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from lodestrata.functions import names, text, urls
from lodestrata.operators import checks, entries, extract, relations, replay, serve, store
from lodestrata.plans import registry

SKIPPED = {"p1_found", "p5_found", "p5_zones", "p6_found", "p6_descendants"}


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(float(r[i])) if isinstance(r[i], float) else str(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def oracle(small):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{small}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(set(registry.oracles()) - SKIPPED))
def test_query_equals_sql(spark, small, oracle, name):
    df = registry.queries()[name](spark, small)
    found = oracle.execute(registry.oracles()[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, found.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracles())))
def test_query_runs(spark, small, name):
    assert registry.queries()[name](spark, small).count() >= 0


def one(spark, column, *values, schema="v string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], schema).select(column).collect()]


def test_names(spark):
    assert one(spark, names.normalize_name("v"), "Straße  ＡＢ-c_1", "", None) == ["strasse ab c_1", "", None]
    assert one(spark, names.corpus_id(F.col("v")), "0012", "0", "-1", "x", "", None) == ["12", None, None, None, None, None]
    assert one(spark, names.safe_filename(F.col("v")), "a/b.bin", "/a", "a//b", "../x", "a\\b", "a\tb", "x" * 1025) == [True] + [False] * 6
    assert one(spark, names.stable_id("model_alias", F.col("v")), "é")[0].startswith("model-alias_")
    assert names.looks_distinctive("AlphaNet") and names.looks_distinctive("alpha", quoted=True) and not names.looks_distinctive("plain words") and not names.looks_distinctive("Alpha", strong=True)
    assert names.looks_title_family("Fourier Neural Operators") and not names.looks_title_family("Deep Neural Networks") and not names.looks_title_family("The Alpha Model")


@pytest.mark.parametrize(
    ("raw", "made"),
    [
        (" HTTPS://User@Docs.Example:443//a//b/?utm_x=1&b=2&a=1#f).", "https://docs.example/a/b?a=1&b=2"), ("http://h.test:80", "http://h.test/"), ("http://h.test:8080/", "http://h.test:8080/"), ("ftp://h.test/x", "ftp://h.test/x"),
        ("https://h.test/?q=", "https://h.test/?q="), ("not a url", "not a url"),
    ],
)
def test_canonical_url(raw, made):
    assert urls.canonical_url(raw) == made


def test_urls(spark):
    assert one(spark, urls.canonicalize_url("v"), "http://h.test:99999/x", None) == [None, None]
    said = "See https://a.test/x for more. The official implementation is at https://a.test/y, model weights: https://a.test/z and https://a.test/x"
    assert [(u, urls.relation_of(said, a, b)) for u, a, b in urls.mentions(said)] == [("https://a.test/x", "embedded"), ("https://a.test/y", "official_implementation"), ("https://a.test/z", "weights")]
    assert [urls.repository_name(u) for u in ("git@github.com:o/r.git", "https://github.com/o/r/", "ssh://git@github.com:22/o/r", "https://u@github.com/o/r", "https://github.com/o/r/x", "https://gitlab.com/o/r", "http://github.com:81/o/r")] == ["o/r"] * 3 + [None] * 4
    assert [urls.doi_in(t) for t in ("x 10.5555/Ab(1)x.", "10.5555/a,", "none", "[10.1234/x]")] == ["10.5555/ab(1)x", "10.5555/a", None, "10.1234/x"]
    assert urls.artifact_urls("doi:10.5555/q https://github.com/o/r https://www.w3.org/x https://github.com/o/r") == ["https://doi.org/10.5555/q", "https://github.com/o/r"]
    df = spark.createDataFrame([("arxiv", "2401.01234v2"), ("DOI", "10.5555/x"), ("doi", "11.1/x"), ("pubmed", "012"), ("PMCID", "77"), ("acl", "P19-1001"), ("dblp", "conf/x/Y"), ("mag", "1")], "s string, v string")
    assert [r[0] for r in df.select(urls.external_id_url(F.col("s"), F.col("v"))).collect()] == [
        "https://arxiv.org/abs/2401.01234v2", "https://doi.org/10.5555/x", None, None, "https://pmc.ncbi.nlm.nih.gov/articles/PMC77/", "https://aclanthology.org/P19-1001/", "https://dblp.org/rec/conf/x/Y", None,
    ]
    ids = spark.createDataFrame([("arxiv", "2401.01234V3"), ("doi", "doi:10.5/A"), ("doi", "https://doi.org/10.5/A"), ("cloudflare-workers-ai:model", "@cf/x"), ("n", "V")], "n string, v string")
    assert [tuple(r[0]) for r in ids.select(urls.normalized_identifier(F.col("n"), F.col("v"))).collect()] == [("arxiv", "2401.01234"), ("doi", "10.5/a"), ("doi", "10.5/a"), ("cloudflare:workers-ai", "@cf/x"), ("n", "V")]


def test_texts(spark):
    df = spark.createDataFrame([("A title", "One. Two has Alpha in it! Three", "text:13:18"), ("A title", "x", "title:2:7"), ("t", "x", "text:0:9"), ("t", "x", "bad")], "title string, text string, loc string")
    found = [r[0] and (r[0]["evidence"], r[0]["support"]) for r in df.select(text.locate_evidence(F.col("title"), F.col("text"), F.col("loc"))).collect()]
    assert found == [("Alpha", " Two has Alpha in it!"), ("title", "A title\nx"), None, None]
    assert one(spark, text.reconstruct_abstract(F.col("v")), '{"b":[1],"a":[0,2],"c":[1,-4]}', "bad", None) == ["a b a", "", ""]
    spans = spark.createDataFrame([(100, 50, 60), (100, 2, 5), (100, 95, 99), (100, 0, 100)], "n int, a int, b int")
    assert [tuple(r[0]) for r in spans.select(text.bounded_context(F.col("n"), F.col("a"), F.col("b"), 40)).collect()] == [(30, 70), (0, 40), (60, 100), (0, 100)]
    import zlib

    assert text.pdf_text(b"(Plain) Tj stream\n" + zlib.compress(b"(Packed) Tj") + b"\nendstream") == "Plain\nPacked"
    assert text.json_urls({"b": ["https://y.test", " https://n.test"], "a": "http://x.test"}) == [("http://x.test", "$.a"), ("https://y.test", "$.b[0]")]


@pytest.mark.parametrize(
    ("title", "body", "kind", "expected"),
    [
        ("", "We introduce AlphaNet, a deep neural network for folding.", "paper", [("AlphaNet", 0.78)]), ("", "We present 'alpha', a neural network.", "paper", [("alpha", 0.80)]), ("", "We introduce MCMC2, a statistical model.", "paper", []),
        ("BetaFold: a neural network for proteins", "Text.", "paper", [("BetaFold", 0.66)]), ("", "# Gamma Net\n\nA deep learning model.", "model_card", [("Gamma Net", 0.70)]), ("", "We introduce DeltaX for folding. DeltaX is a neural network.", "paper", [("DeltaX", 0.78)]),
        ("", "a neural operator, which we called EpsilonOp, works", "paper", [("EpsilonOp", 0.80)]), ("", "plain prose about things", "paper", []), ("", "", "paper", []),
    ],
)
def test_introductions(title, body, kind, expected):
    assert [(n, c) for n, _, c, _ in extract.introduced(title, body, kind)] == expected


def test_html():
    page = extract.parse_page('<html><head><title> A  b </title><link rel="canonical" href="/c"><meta name="citation_doi" content="10.5555/x"></head><body>Hi <script>no</script><a href="p.pdf#1">P</a><a href="mailto:x">m</a></body>', "https://h.test/d/")
    assert (page["title"], page["text"], page["links"], page["canonical"], page["kind"], page["doi"], page["full_text"]) == ("A b", "Hi\nP\nm", ["https://h.test/d/p.pdf"], "https://h.test/c", "paper", "10.5555/x", ["https://h.test/d/p.pdf"])


def test_components(spark):
    chain = [(i, f"e{i}") for i in range(60)] + [(i + 1, f"e{i}") for i in range(60)]
    star = [(1000 + i, "hub") for i in range(50)] + [(7, None), (None, "q"), (2000, "alone")]
    out = {r["node"]: r["component"] for r in entries.components(spark.createDataFrame(chain + star, "node long, anchor string")).collect()}
    assert all(out[i] == 0 for i in range(61)) and all(out[1000 + i] == 1000 for i in range(50)) and out[2000] == 2000 and len(out) == 112
    assert entries.components(spark.createDataFrame([], "node long, anchor string")).count() == 0


def test_replay_rejects_and_alias_conflicts(spark):
    events = spark.createDataFrame([("a", "abstracts", "upsert", 1, 0, "x"), ("a", "papers", "upsert", 1, 0, "p"), ("b", "papers", "delete", 1, 0, None), ("c", "abstracts", "upsert", 2, 0, "y")], "k string, dataset string, operation string, transition long, position long, value string")
    assert sorted(r["k"] for r in replay.replay_rejects(events, "k").collect()) == ["b", "c"]
    out = {r["k"]: (r["tombstone"], r["paper"], r["abstract"]) for r in replay.replay_diff_state(events, "k").collect()}
    assert out == {"a": (False, "p", "x"), "b": (True, None, None)}
    with pytest.raises(checks.Violation):
        none = spark.createDataFrame([], "k string, v string")
        replay.join_snapshot_state(none, spark.createDataFrame([("z", "v")], "k string, v string"), none.withColumnRenamed("v", "alias"), "k", "alias")
    shards = spark.createDataFrame([("r", 0), ("r", 2), ("s", 0), ("s", 1)], "g string, p long")
    assert [r["g"] for r in replay.order_gaps(shards, ["g"], "p").collect()] == ["r"]


def test_citations(spark):
    owners = spark.createDataFrame([("k1", "A"), ("k2", "B"), ("k3", "A"), ("k3", "B")], "key string, entry string")
    links = spark.createDataFrame([("A", "cites", None, "k2"), ("A", "cited_by", None, "k2"), ("B", "cites", "incoming", "k1"), ("A", "cites", None, "k1"), ("A", "cites", None, "k3"), ("B", "cites", "symmetric", "k1")], "entry string, predicate string, direction string, key string")
    assert sorted((r["source_id"], r["target_id"]) for r in entries.citations_closed(links, owners).collect()) == [("A", "B"), ("B", "A")]


def test_checkpoint_bridges(spark):
    rows = [(1, "s1", "r1", "u", "checkpoint"), (2, "s2", "r2", "u", "weights"), (2, "s2", "r2", "u", "checkpoint"), (3, "s1", "r3", "v", "checkpoint"), (4, "s1", "r4", "v", "checkpoint"), (5, "s1", "r5", "w", "checkpoint"), (6, "s2", "r6", "w", "weights")]
    out = entries.checkpoint_bridges(spark.createDataFrame(rows, "candidate long, source string, source_record_id string, url string, relation string")).collect()
    assert sorted(r["candidate"] for r in out) == [1, 2]


def test_store(spark, tmp_path):
    root = str(tmp_path / "store")
    a = spark.createDataFrame([(1, "x"), (2, None)], "id long, v string")
    first = store.sink_commit({"a": a, "b": a.limit(0)}, root)
    second = store.sink_commit({"a": a.orderBy("v"), "b": a}, root)
    assert first["tables"]["a"] == second["tables"]["a"] and first["tables"]["b"] != second["tables"]["b"] and second["parent"] == first["commit"]
    assert store.scan_store(spark, root, "a", verify=True).count() == 2
    with pytest.raises(checks.Violation):
        store.scan_store(spark, root, "zzz")
    with pytest.raises(checks.Violation):
        store.snapshot_tombstones(a, a.limit(0), "id")
    assert store.snapshot_tombstones(a, a.limit(0), "id", None).count() == 2


def test_validation_and_quarantine(spark):
    schema = "source_record_id string, kind string, canonical_url string, title string, models array<struct<local_id:string,name:string,confidence:double>>, links array<struct<url:string,model_local_ids:array<string>>>, deleted boolean"
    rows = [("1", "paper", "u", "t", [("m", "M", 0.5)], [("l", ["m"])], False), ("2", "odd", "u", "t", [], [], False), ("3", "paper", "u", "t", [("m", "M", 1.5)], [], False), ("4", "paper", "u", "t", [], [("l", ["x"])], False), ("5", "paper", "u", "t", [("m", "M", 0.1)], [], True), ("6", "paper", " ", "t", [], [], False), ("7", "paper", "u", "t", [("m", "M", 0.1), ("m", "N", 0.1)], [], False)]
    good, bad = store.validate_records(spark.createDataFrame(rows, schema))
    assert [r["source_record_id"] for r in good.collect()] == ["1"] and bad.count() == 6
    empty = spark.createDataFrame([], "source string, source_record_id string, stage string, error string, attempts long, first_seen_at string, last_seen_at string, run_id int")
    once = store.quarantine(bad, empty, "s", "ingest", 1, "t1")
    twice = store.quarantine(bad, once, "s", "ingest", 2, "t2").collect()
    assert {(r["attempts"], r["first_seen_at"], r["last_seen_at"]) for r in twice} == {(2, "t1", "t2")}


def test_identity(spark):
    hints = spark.createDataFrame([("a1", "m", ["x:1", "x:2"]), ("a2", "m", ["x:1", "y:9"]), ("a3", "m", ["z:5"]), ("a4", "m", []), ("a5", "m", ["z:5"])], "artifact_id string, local_id string, identifiers array<string>")
    claims = spark.createDataFrame([("r1", "X", "1", "M1", "bound"), ("r1", "y", "9", "M2", "bound"), ("old", "z", "5", "M3", "bound"), ("r1", "z", "5", "M4", "conflict")], "artifact_revision_id string, namespace string, value string, model_id string, resolution_status string")
    artifacts = spark.createDataFrame([(1, "r1"), (0, "old")], "active int, current_revision_id string")
    out = {r["artifact_id"]: (r["resolution_status"], r["model_id"]) for r in store.resolve_model(hints, claims, artifacts).collect()}
    assert out["a1"] == ("exact_identifier", "M1") and out["a2"][0] == "identifier_conflict" and out["a3"][0] == "exact_identifier_new" and out["a3"] == out["a5"] and out["a4"][0] == "source_scoped"


def test_relations(spark):
    claims = spark.createDataFrame([("k", "b", 0.5, "1"), ("k", "a", 0.9, "2"), ("k", "c", 0.7, "3"), ("k", "a", 0.1, "0"), ("l", "z", 1.0, "x"), (None, "y", 1.0, "x")], "key string, artifact string, confidence double, claim string")
    star = relations.join_identity_star(claims, ["key"], "artifact", F.col("confidence"), F.col("claim")).collect()
    assert sorted((r["source_id"], r["target_id"], r["confidence"], r["claim"]) for r in star) == [("a", "b", 0.1, "0"), ("a", "c", 0.1, "0")]


def test_frontier_ranks(spark):
    df = spark.createDataFrame([("zeta one", "q"), ("zeta", "q"), ("other", "has zeta"), ("a zeta", "q"), ("none", "q")], "n string, i string")
    assert [r[0] for r in df.select(serve.search_rank(F.col("n"), F.col("i"), " Zeta ")).collect()] == [1, 0, 0, 2, None]
    assert [r[0] for r in df.select(serve.search_rank(F.col("n"), F.col("i"), "")).collect()] == [3] * 5


def test_whole_tables_are_taken(spark, small):
    queries = registry.queries()
    read = lambda name: spark.read.parquet(f"{small}/{name}.parquet")
    assert queries["sort_export_models"](spark, small).count() == read("models").count()
    assert queries["identifier_from_source_url"](spark, small).count() == read("documents").count()
    spans = queries["bounded_context_mentions"](spark, small).collect()
    assert spans and any(r["context_start"] > 0 for r in spans)
    assert all(0 <= r["context_start"] < r["context_end"] <= r["size"] and r["context_end"] - r["context_start"] <= 200 for r in spans)
    assert all(r["context_start"] <= r["start"] and r["end"] <= r["context_end"] for r in spans if r["end"] - r["start"] <= 200)
    assert queries["antijoin_snapshot_customers"](spark, small).where("c_custkey % 10 = 3").count() > 0
