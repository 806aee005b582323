"""Readers of the formats in which sources publish."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.checks import Violation, assert_empty
from ..operators.extract import parse_page


def jsonl(spark: SparkSession, path: str, schema: str, most_bytes: int = 16 << 20) -> DataFrame:
    """Rows of (gzipped) JSON lines with their text as raw; overlong and malformed lines are an error when read_checked is used."""
    lines = spark.read.text(path).where(F.length("value") > 0)
    return lines.select(F.col("value").alias("raw"), F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("row"), (F.octet_length("value") > most_bytes).alias("overlong"))


def jsonl_checked(spark: SparkSession, path: str, schema: str, most_bytes: int = 16 << 20) -> DataFrame:
    rows = jsonl(spark, path, schema, most_bytes)
    assert_empty(rows.where("overlong or try_parse_json(raw) is null").select(F.substring("raw", 1, 80).alias("raw")), "overlong or malformed line")
    return rows.select("raw", "row.*")


_WARC_HEAD = re.compile(rb"(?m)^WARC/1\.[01]\r?$")


def warc_records(data: bytes) -> Iterator[dict]:
    """Records of a WARC file: headers, content and its sha256. A record that ends early or repeats an id is an error."""
    stream, seen = io.BytesIO(data), set()
    while line := stream.readline():
        if not line.strip():
            continue
        if not _WARC_HEAD.match(line.rstrip(b"\r\n") + b"\n"):
            raise Violation("not a WARC record")
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers.get("content-length", -1))
        content = stream.read(size) if size >= 0 else b""
        if size < 0 or len(content) != size:
            raise Violation("a WARC record ends early")
        if headers.get("warc-record-id") in seen:
            raise Violation("a WARC record id repeats")
        seen.add(headers.get("warc-record-id"))
        stated = headers.get("warc-block-digest", "")
        if stated.lower().startswith("sha1:") and base64.b32encode(hashlib.sha1(content).digest()).decode() != stated[5:]:
            raise Violation("a WARC block differs from its digest")
        yield {"type": headers.get("warc-type"), "record_id": headers.get("warc-record-id"), "uri": headers.get("warc-target-uri"), "date": headers.get("warc-date"), "content": content.decode("utf-8", "replace"),
               "content_bytes": size, "content_sha256": hashlib.sha256(content).hexdigest()}


def wet(spark: SparkSession, path: str) -> DataFrame:
    """The conversion records of WET files, with path and ordinal. One task a file, as a gzipped archive can't be split."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, data in zip(frame["path"], frame["content"]):
                raw = gzip.decompress(data) if bytes(data[:2]) == b"\x1f\x8b" else bytes(data)
                rows = [{"path": name, "ordinal": i, **r} for i, r in enumerate(x for x in warc_records(raw) if x["type"] == "conversion")]
                yield pd.DataFrame(rows, columns=["path", "ordinal", "type", "record_id", "uri", "date", "content", "content_bytes", "content_sha256"])

    return files.mapInPandas(run, "path string, ordinal long, type string, record_id string, uri string, date string, content string, content_bytes long, content_sha256 string")


GH_EVENT = "id string, type string, actor struct<login:string>, repo struct<id:long,name:string,url:string>, payload string, created_at timestamp"


def gharchive(spark: SparkSession, path: str, hour: str) -> DataFrame:
    """Events of one archive hour (YYYY-MM-DDTHH); an event outside it is an error."""
    events = spark.read.schema(GH_EVENT).json(path)
    start = F.to_timestamp(F.lit(hour), "yyyy-MM-dd'T'HH")
    assert_empty(events.where(~F.coalesce((F.col("created_at") >= start) & (F.col("created_at") < start + F.expr("interval 1 hour")), F.lit(False))).select("id"), "event outside its hour")
    return events


def openaire_tar(spark: SparkSession, path: str) -> DataFrame:
    """member, line, payload of the gzipped JSON lines in tar archives."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for data in frame["content"]:
                with tarfile.open(fileobj=io.BytesIO(data)) as archive:
                    for member in archive:
                        if member.isfile():
                            lines = gzip.decompress(archive.extractfile(member).read()).decode("utf-8").splitlines()
                            yield pd.DataFrame([(member.name, i, x) for i, x in enumerate(lines) if x.strip()], columns=["member", "line", "payload"])

    return files.mapInPandas(run, "member string, line long, payload string")


def orc_origins(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.orc(path).select("url")


def pubmed_xml(spark: SparkSession, path: str) -> DataFrame:
    """pmid, title, abstract, journal, authors, ids of the articles in XML files."""
    schema = (
        "MedlineCitation struct<PMID:string,Article:struct<ArticleTitle:string,Abstract:struct<AbstractText:array<string>>,Journal:struct<Title:string>,"
        "AuthorList:struct<Author:array<struct<LastName:string,ForeName:string>>>>>, PubmedData struct<ArticleIdList:struct<ArticleId:array<struct<_IdType:string,_VALUE:string>>>>"
    )
    rows = spark.read.format("xml").option("rowTag", "PubmedArticle").schema(schema).load(path)
    article = F.col("MedlineCitation.Article")
    authors = F.transform(article["AuthorList"]["Author"], lambda a: F.concat_ws(" ", a["ForeName"], a["LastName"]))
    ids = F.transform(F.col("PubmedData.ArticleIdList.ArticleId"), lambda i: F.struct(i["_IdType"].alias("namespace"), i["_VALUE"].alias("value")))
    return rows.select(
        F.col("MedlineCitation.PMID").alias("pmid"), article["ArticleTitle"].alias("title"), F.array_join(article["Abstract"]["AbstractText"], "\n").alias("abstract"),
        article["Journal"]["Title"].alias("journal"), authors.alias("authors"), ids.alias("ids"),
    )


def csv_mapped(spark: SparkSession, path: str, mapping: dict[str, str]) -> DataFrame:
    """Columns of a CSV with a header under the names of mapping (name -> header); a missing header is an error."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    missing = set(mapping.values()) - set(rows.columns)
    if missing:
        raise Violation(f"the CSV lacks {sorted(missing)}")
    return rows.select(*[F.trim(F.col(f"`{h}`")).alias(n) for n, h in mapping.items()])


def json_catalog(df: DataFrame, document: str, items: str, fields: dict[str, str]) -> DataFrame:
    """A row per item of a JSON document; items and fields are JSON paths, fields relative to an item."""
    each = df.select(F.explode(F.expr(f"try_variant_get(try_parse_json({document}), '{items}', 'array<variant>')")).alias("item"))
    return each.select(*[F.try_variant_get("item", path, "string").alias(name) for name, path in fields.items()])


def html_catalog(pages: DataFrame, key: str, html: str, url: str, link_pattern: str) -> DataFrame:
    """key, url: the links of catalog pages whose address matches link_pattern, each once a page, in order."""
    rows = pages.select(F.col(key).alias("key"), F.coalesce(html, F.lit("")).alias("html"), F.coalesce(url, F.lit("")).alias("url"))
    kind = dict(rows.dtypes)["key"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = re.compile(link_pattern)
        for frame in frames:
            out = [(k, i, u) for k, h, p in zip(frame["key"], frame["html"], frame["url"]) for i, u in enumerate(x for x in parse_page(h, p)["links"] if wanted.search(x))]
            yield pd.DataFrame(out, columns=["key", "ordinal", "url"])

    return rows.mapInPandas(run, f"key {kind}, ordinal int, url string").withColumnRenamed("key", key)


_RULE = re.compile(r"^\s*\|?\s*:?-{2,}")
_MARKDOWN_LINK = re.compile(r"\[([^\]]+)\]\(([^)\s]+)\)")


def _cells(line: str) -> list[str]:
    return [c.strip().replace("\\|", "|") for c in re.split(r"(?<!\\)\|", line.strip().removeprefix("|").removesuffix("|"))]


def markdown_rows(text: str, header: str) -> Iterator[tuple[str, int, str, list[str], dict[str, str]]]:
    """(heading, line, name, links, cells) of the rows of tables that have a column whose header matches."""
    lines, heading, columns, named = text.splitlines(), "", None, None
    for n, line in enumerate(lines):
        if line.startswith("#"):
            heading, columns = line.lstrip("#").strip(), None
        elif "|" in line and n + 1 < len(lines) and _RULE.match(lines[n + 1]):
            columns = _cells(line)
            named = next((i for i, c in enumerate(columns) if re.search(header, c, re.I)), None)
        elif columns is not None and "|" in line and not _RULE.match(line):
            cells = _cells(line)
            if named is not None and named < len(cells) and cells[named]:
                name = _MARKDOWN_LINK.sub(r"\1", cells[named])
                yield heading, n + 1, name, [u for c in cells for _, u in _MARKDOWN_LINK.findall(c)], dict(zip(columns, cells))
        elif not line.strip():
            columns = None


def markdown_table(documents: DataFrame, key: str, text: str, header: str) -> DataFrame:
    """key, heading, line, name, links, cells of the table rows of Markdown documents."""
    rows = documents.select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    kind = dict(rows.dtypes)["key"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = [(k, *r) for k, t in zip(frame["key"], frame["text"]) for r in markdown_rows(t, header)]
            yield pd.DataFrame(out, columns=["key", "heading", "line", "name", "links", "cells"])

    return rows.mapInPandas(run, f"key {kind}, heading string, line int, name string, links array<string>, cells map<string,string>").withColumnRenamed("key", key)


def dedupe_merge_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of equal keys as one: links united in order, distinct descriptions joined, the first line kept."""
    ordered = F.array_sort(F.collect_list(F.struct("line", "links", "description")))
    merged = rows.groupBy(*keys).agg(ordered.alias("r"))
    return merged.select(
        *keys, F.get("r", 0)["line"].alias("line"), F.array_distinct(F.flatten(F.transform("r", lambda x: x["links"]))).alias("links"),
        F.array_join(F.array_distinct(F.filter(F.transform("r", lambda x: x["description"]), lambda d: d.isNotNull() & (d != ""))), "\n").alias("description"),
    )


def entry_seeds(spark: SparkSession, path: str) -> DataFrame:
    """Seeds of a file that is a JSON object, an array, {"seeds": [...]} or JSON lines, one JSON text a row."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def read(data: bytes) -> list[str]:
        text = bytes(data).decode("utf-8").strip()
        try:
            found = json.loads(text)
        except ValueError:
            found = [json.loads(x) for x in text.splitlines() if x.strip()]
        found = found.get("seeds", [found]) if isinstance(found, dict) else found
        return [json.dumps(x, ensure_ascii=False, sort_keys=True, separators=(",", ":")) for x in found]

    split = F.pandas_udf(lambda s: s.map(read), T.ArrayType(T.StringType()))
    return files.select(F.explode(split("content")).alias("seed"))
