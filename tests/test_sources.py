import base64
import datetime as dt
import gzip
import hashlib
import io
import json
import tarfile

import pytest
from pyspark.sql import functions as F

from lodestrata.operators.checks import Violation
from lodestrata.sources import decode, lake, readers
from lodestrata.streaming import microbatch


def warc(kind, uri, content, record="<urn:1>", extra=""):
    body = content.encode()
    return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {record}\r\nWARC-Target-URI: {uri}\r\n{extra}Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


def test_wet(spark, tmp_path):
    digest = base64.b32encode(hashlib.sha1("Grüße".encode()).digest()).decode()
    data = warc("warcinfo", "", "x", "<urn:0>") + warc("conversion", "https://a.test", "Grüße", "<urn:1>", f"WARC-Block-Digest: sha1:{digest}\r\n") + warc("conversion", "https://b.test", "", "<urn:2>")
    (tmp_path / "a.wet.gz").write_bytes(gzip.compress(data))
    rows = readers.wet(spark, str(tmp_path / "a.wet.gz")).orderBy("ordinal").collect()
    assert [(r["uri"], r["content"], r["content_bytes"]) for r in rows] == [("https://a.test", "Grüße", 7), ("https://b.test", "", 0)]
    for bad in (data[:-20], warc("conversion", "u", "x") + warc("conversion", "u", "y"), b"junk", warc("conversion", "u", "x", extra="WARC-Block-Digest: sha1:AAAA\r\n")):
        with pytest.raises(Violation):
            list(readers.warc_records(bad))


def test_jsonl_and_seeds(spark, tmp_path):
    (tmp_path / "x.jsonl.gz").write_bytes(gzip.compress(b'{"id":"1","n":2}\n\n{"id":"2"}\n'))
    assert [tuple(r)[1:] for r in readers.jsonl_checked(spark, str(tmp_path / "x.jsonl.gz"), "id string, n int").orderBy("id").collect()] == [("1", 2), ("2", None)]
    (tmp_path / "bad.jsonl").write_text('{"id":\n')
    with pytest.raises(Violation):
        readers.jsonl_checked(spark, str(tmp_path / "bad.jsonl"), "id string")
    for i, content in enumerate(('{"a":1}', '[{"a":1},{"a":2}]', '{"seeds":[{"a":1}]}', '{"a":1}\n{"a":2}\n')):
        (tmp_path / f"s{i}.json").write_text(content)
    assert [readers.entry_seeds(spark, str(tmp_path / f"s{i}.json")).count() for i in range(4)] == [1, 2, 1, 2]


def test_gharchive(spark, tmp_path):
    event = {"id": "1", "type": "PushEvent", "repo": {"id": 5, "name": "o/r"}, "created_at": "2024-01-01T10:59:59Z"}
    (tmp_path / "e.json").write_text(json.dumps(event) + "\n")
    assert readers.gharchive(spark, str(tmp_path / "e.json"), "2024-01-01T10").count() == 1
    with pytest.raises(Violation):
        readers.gharchive(spark, str(tmp_path / "e.json"), "2024-01-01T11")


def test_openaire_orc_csv(spark, tmp_path):
    packed = gzip.compress(b'{"id":"1"}\n{"id":"2"}\n')
    with tarfile.open(tmp_path / "a.tar", "w") as out:
        info = tarfile.TarInfo("part.json.gz")
        info.size = len(packed)
        out.addfile(info, io.BytesIO(packed))
    assert [r["payload"] for r in readers.openaire_tar(spark, str(tmp_path / "a.tar")).orderBy("line").collect()] == ['{"id":"1"}', '{"id":"2"}']
    spark.createDataFrame([("u", 1)], "url string, x int").write.orc(str(tmp_path / "o.orc"))
    assert readers.orc_origins(spark, str(tmp_path / "o.orc")).columns == ["url"]
    (tmp_path / "m.csv").write_text('Model,Note\n"A ""x""", n\nB,\n')
    assert [tuple(r) for r in readers.csv_mapped(spark, str(tmp_path / "m.csv"), {"name": "Model", "note": "Note"}).collect()] == [('A "x"', "n"), ("B", None)]
    with pytest.raises(Violation):
        readers.csv_mapped(spark, str(tmp_path / "m.csv"), {"name": "Missing"})


def test_pubmed(spark, tmp_path):
    (tmp_path / "p.xml").write_text(
        "<Set><PubmedArticle><MedlineCitation><PMID>7</PMID><Article><ArticleTitle>T</ArticleTitle><Abstract><AbstractText>a</AbstractText><AbstractText>b</AbstractText></Abstract><Journal><Title>J</Title></Journal>"
        "<AuthorList><Author><LastName>L</LastName><ForeName>F</ForeName></Author></AuthorList></Article></MedlineCitation><PubmedData><ArticleIdList><ArticleId IdType=\"doi\">10.5/x</ArticleId></ArticleIdList></PubmedData></PubmedArticle></Set>"
    )
    row = readers.pubmed_xml(spark, str(tmp_path / "p.xml")).first()
    assert (row["pmid"], row["title"], row["abstract"], row["journal"], row["authors"], [tuple(i) for i in row["ids"]]) == ("7", "T", "a\nb", "J", ["F L"], [("doi", "10.5/x")])


def test_catalogs(spark):
    df = spark.createDataFrame([(1, '{"data":{"items":[{"id":"a","meta":{"n":1}},{"id":"b"}]}}'), (2, "bad"), (3, None)], "k int, doc string")
    assert [tuple(r) for r in readers.json_catalog(df, "doc", "$.data.items", {"id": "$.id", "n": "$.meta.n"}).collect()] == [("a", "1"), ("b", None)]
    html = spark.createDataFrame([(1, '<a href="/models/x">X</a><a href="/about">A</a><a href="/models/y">Y</a>', "https://h.test/")], "k int, html string, url string")
    assert [r["url"] for r in readers.html_catalog(html, "k", "html", "url", "/models/").orderBy("ordinal").collect()] == ["https://h.test/models/x", "https://h.test/models/y"]
    text = "# Zoo\n\n| Model | Link |\n|---|:-:|\n| [A](https://a.test) | [w](https://w.test) |\n| B \\| C | |\n\n| Other |\n|---|\n| x |\n"
    rows = readers.markdown_table(spark.createDataFrame([(1, text), (2, None)], "k int, t string"), "k", "t", "^model$").orderBy("line").collect()
    assert [(r["heading"], r["name"], r["links"]) for r in rows] == [("Zoo", "A", ["https://a.test", "https://w.test"]), ("Zoo", "B | C", [])]
    many = spark.createDataFrame([("n", 2, ["b", "a"], "d2"), ("n", 1, ["a"], "d1"), ("n", 3, ["c"], "d1")], "name string, line int, links array<string>, description string")
    assert tuple(readers.dedupe_merge_rows(many, ["name"]).first()) == ("n", 1, ["a", "b", "c"], "d1\nd2")


def test_decoders(spark):
    def payload(schema, *rows):
        return spark.createDataFrame([(str(i), json.dumps(r)) for i, r in enumerate(rows)], "source_record_id string, payload_json string")

    good = {"content": "hé", "content_bytes": 3, "content_sha256": hashlib.sha256("hé".encode()).hexdigest(), "warc": {"type": "conversion"}}
    wet = payload(None, good, good | {"content_bytes": 2}, good | {"content_sha256": "0"}, good | {"warc": {"type": "request"}}, {})
    assert [r["issue"] for r in decode.decode_wet_document(wet).orderBy("source_record_id").collect()] == [None, "byte count", "digest", "record type", "no content"]
    events = payload(None, {"id": "1", "type": "X", "repo": {"id": 3, "name": "o/r"}, "created_at": "2024-01-01T00:00:00Z"}, {"id": "2", "repo": {"id": 0, "name": "o/r"}}, {"id": "3", "repo": {"id": 4, "name": "bad"}})
    assert [r["issue"] for r in decode.decode_gharchive_event(events).orderBy("event_id").collect()] == [None, "repository id", "repository name"]
    url = "https://github.com/O/r.git"
    origins = spark.createDataFrame([(url, base64.b64encode(url.encode()).decode(), hashlib.sha256(url.encode()).hexdigest()), (url, base64.b64encode(url.encode()).decode(), "0"), (None, "", "")], "origin_url string, origin_url_base64 string, origin_url_sha256 string")
    assert sorted((r["repository"], r["issue"]) for r in decode.decode_swh_origin(origins).collect() if r["issue"] is None) == [("O/r", None)]
    software = {"id": "s", "type": "software", "mainTitle": "T", "pids": [{"scheme": "DOI", "value": "10.5/x"}], "instances": [{"urls": ["u0", "u1"]}], "codeRepositoryUrl": "c", "documentationUrls": ["d"]}
    row = decode.project_openaire_software(payload(None, software, software | {"type": "publication"})).collect()
    assert len(row) == 1 and [(x["url"], x["locator"]) for x in row[0]["links"]] == [("c", "$.codeRepositoryUrl"), ("d", "$.documentationUrls[0]"), ("u0", "$.instances[0].urls[0]"), ("u1", "$.instances[0].urls[1]")]
    edge = {"source": "a", "sourceType": "software", "target": "b", "targetType": "publication", "relType": {"name": "cites"}}
    assert decode.project_openaire_relation(payload(None, edge, edge | {"targetType": "software"})).count() == 1
    release = {"action": "published", "release": {"tag_name": "v1", "name": "", "assets": [{"name": "m.safetensors", "label": "", "browser_download_url": "u"}, {"name": "sums.txt", "browser_download_url": "v"}]}}
    assets = spark.createDataFrame([("1", "ReleaseEvent", json.dumps(release)), ("2", "PushEvent", "{}"), ("3", "ReleaseEvent", json.dumps(release | {"action": "edited"}))], "event_id string, type string, payload string")
    assert [(r["file"], r["name"], r["confidence"]) for r in decode.project_release_assets(assets).collect()] == [("m.safetensors", "m", 0.2)]


def lake_rows(spark, n=3):
    rows = [(f"r{i}", "upsert", json.dumps({"i": i}), None, dt.datetime(2026, 1, 1), 0, None, None, None, None) for i in range(n)]
    return lake.with_hash(spark.createDataFrame(rows, lake.SCHEMA))


def test_lake(spark, tmp_path):
    root = str(tmp_path)
    first = lake.land(lake_rows(spark), root, "s", "papers", "2026-01", "0", "c0", 3)
    assert lake.land(lake_rows(spark), root, "s", "papers", "2026-01", "0", "c0") == first
    with pytest.raises(Violation):
        lake.land(lake_rows(spark), root, "s", "papers", "2026-01", "0", "other")
    with pytest.raises(Violation):
        lake.land(lake_rows(spark), root, "s", "papers", "2026-01", "1", "c1", 4)
    with pytest.raises(Violation):
        lake.land(lake_rows(spark).withColumn("operation", F.lit("odd")), root, "s", "papers", "2026-01", "2", "c2")
    with pytest.raises(Violation):
        lake.scan_release(spark, root, "s", "papers", "2026-01")
    assert lake.scan_shard(spark, root, "s", "papers", "2026-01", "0").count() == 3
    with pytest.raises(Violation):
        lake.seal(root, "s", "papers", "2026-01", {"0", "1"})
    lake.seal(root, "s", "papers", "2026-01", {"0"})
    assert lake.scan_release(spark, root, "s", "papers", "2026-01", ["source_record_id"]).columns == ["source_record_id"]
    assert lake.releases(root) == [{"source": "s", "dataset": "papers", "release": "2026-01", "shards": 1, "rows": 3}]
    assert lake.ready(lake.releases(root), {"papers"}) == ["2026-01"] and lake.ready(lake.releases(root), {"papers", "abstracts"}) == []
    controls = spark.createDataFrame([("s", "papers", "r", str(i)) for i in range(4)], "source string, dataset string, release string, shard string")
    assert [r["shard"] for r in lake.plan(controls.where("shard = '0'"), controls, ["shard"], 2).collect()] == ["1", "2"]
    assert lake.plan(controls.where("shard = '0'").withColumn("release", F.lit("another")), controls, ["shard"], 2).first()["shard"] == "0"
    with pytest.raises(Violation):
        lake.plan(controls.limit(0), controls.union(controls), ["shard"], 2)


def test_projection_and_export(spark, tmp_path):
    df = spark.createDataFrame([(2, None), (1, "x")], "id int, v string")
    folder = lake.projection(df, str(tmp_path), "p", {"a": 1})
    assert folder == lake.projection(df.limit(0), str(tmp_path), "p", {"a": 1}) and lake.scan_projection(spark, folder, ["id"]).count() == 2
    lake.export_jsonl(df, str(tmp_path / "out"), ["id"])
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        lake.export_jsonl(df, str(tmp_path / "out"), ["id"])


def test_microbatches(spark, tmp_path):
    root = str(tmp_path / "store")

    def fetch(state):
        page = state.get("page", 0)
        return spark.createDataFrame([(page,)], "page int"), {"page": page + 1}, page == 2

    def ingest(rows, tables):
        return {"pages": tables["pages"].unionByName(rows) if "pages" in tables else rows}

    assert microbatch.sync_microbatch(root, "s", fetch, ingest, spark, "sig", most_pages=2) == 2
    assert microbatch.sync_microbatch(root, "s", fetch, ingest, spark, "sig", most_pages=5) == 1
    from lodestrata.operators.store import scan_store

    assert sorted(r[0] for r in scan_store(spark, root, "pages").collect()) == [0, 1, 2]
    with pytest.raises(Violation):
        microbatch.sync_microbatch(root, "s", fetch, ingest, spark, "changed")
    with pytest.raises(Violation):
        microbatch.sync_microbatch(root, "s", lambda state: (spark.range(0), state, False), ingest, spark, "sig")


def test_leases_windows_pipeline(spark):
    now = dt.datetime(2026, 1, 2)
    runs = spark.createDataFrame([(1, "s", "running", now, now - dt.timedelta(hours=7)), (2, "t", "running", now, now)], "id long, source string, status string, started_at timestamp, heartbeat_at timestamp")
    assert {r["id"]: r["status"] for r in microbatch.start_run(runs, "s", now).collect()} == {1: "abandoned", 2: "running", 3: "running"}
    with pytest.raises(Violation):
        microbatch.start_run(runs, "t", now)
    days = microbatch.windows(dt.date(2026, 1, 1), dt.date(2026, 1, 10), 4)
    assert days[-1] == (dt.date(2026, 1, 9), dt.date(2026, 1, 10)) and len(days) == 3
    seen = []
    assert microbatch.backfill({days[0]}, days, lambda a, b: seen.append((a, b))) == set(days) and seen == days[1:]
    assert microbatch.daily_pipeline([("a", lambda: 1), ("b", lambda: 1 / 0), ("c", lambda: 1)]) == {"a": "ok", "b": "ZeroDivisionError: division by zero", "c": "ok"}
    sealed = []
    assert microbatch.bulk_load_and_seal(["0", "1"], lambda s: None, {"0", "1"}, lambda: {"0", "1"}, lambda: sealed.append(1)) == {} and sealed == [1]
    assert "1" in microbatch.bulk_load_and_seal(["0", "1"], lambda s: int(s) and 1 / 0, {"0", "1"}, lambda: {"0", "1"}, lambda: sealed.append(2)) and sealed == [1]


def test_stream(spark, tmp_path):
    spark.createDataFrame([("a", 1), ("b", 1)], "k string, n long").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, n long").parquet(str(tmp_path / "in"))

    def apply(batch, before):
        every = batch if before is None else before.unionByName(batch)
        return every.groupBy("k").agg(F.sum("n").alias("n"))

    microbatch.stream_state(stream, str(tmp_path / "state"), str(tmp_path / "check"), "k", apply).awaitTermination()
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "state/0")).collect()} == {("a", 1), ("b", 1)}
