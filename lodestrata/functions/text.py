"""Sentences, contexts and evidence in texts; texts from inverted indexes, PDF streams and JSON trees."""

from __future__ import annotations

import json
import re
import zlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def first_sentence(text: Column) -> Column:
    """Up to and with the first of . ! ? or line feed; the whole text without one."""
    end = F.length(F.regexp_extract(text, r"(?s)^([^.!?\n]*[.!?\n])", 1))
    return F.when(end > 0, F.substring(text, F.lit(1), end)).otherwise(text)


def containing_sentence(text: Column, start: Column, end: Column) -> Column:
    """The sentence around the 0-based half-open span, its closing mark included."""
    left = F.regexp_extract(F.substring(text, F.lit(1), start), r"(?s)([^.!?\n]*)$", 1)
    right = first_sentence(F.substring(text, end + 1, F.length(text)))
    return F.concat(left, F.substring(text, start + 1, end - start), right)


def bounded_context(length: Column, start: Column, end: Column, limit: int) -> Column:
    """struct(start, end) of at most limit characters: two thirds of the room to the left, the rest right, what is spare back to the left."""
    room = F.lit(limit) - (end - start)
    left = F.least(start, F.floor(room * 2 / 3).cast("int"))
    right = F.least(length - end, room - left)
    more = F.least(start - left, room - left - right)
    wide = (end - start) >= limit
    return F.struct(F.when(wide, start).otherwise(start - left - F.greatest(more, F.lit(0))).alias("start"), F.when(wide, end).otherwise(end + right).alias("end"))


def locate_evidence(title: Column, text: Column, locator: Column) -> Column:
    """struct(field, start, end, evidence, support) of a locator field:start:end; null if it is malformed or outside."""
    form = r"^(title|text):([0-9]+):([0-9]+)$"
    field = F.regexp_extract(locator, form, 1)
    start, end = (F.regexp_extract(locator, form, n).try_cast("int") for n in (2, 3))
    value = F.when(field == "title", title).otherwise(text)
    support = F.when(field == "title", F.concat_ws("\n", title, first_sentence(text))).otherwise(containing_sentence(text, start, end))
    inside = (field != "") & (start < end) & (end <= F.length(value))
    return F.when(inside, F.struct(field.alias("field"), start.alias("start"), end.alias("end"), F.substring(value, start + 1, end - start).alias("evidence"), support.alias("support")))


def reconstruct_abstract(index: Column) -> Column:
    """The text of a JSON object token -> positions; the token named first wins a position. '' for null and malformed JSON."""
    entries = F.map_entries(F.from_json(index, "map<string,array<int>>"))
    placed = F.flatten(F.transform(entries, lambda e, i: F.transform(F.filter(F.coalesce(e["value"], F.array().cast("array<int>")), lambda p: p >= 0), lambda p: F.struct(p.alias("p"), i.alias("i"), e["key"].alias("t")))))
    ordered = F.array_sort(placed)
    kept = F.filter(ordered, lambda x, n: (n == 0) | (F.get(ordered, n - 1)["p"] != x["p"]))
    return F.coalesce(F.array_join(F.transform(kept, lambda x: x["t"]), " "), F.lit(""))


def _shown(content: bytes) -> list[bytes]:
    """The operands of at least two bytes, without brackets inside, of the text operators in a content stream."""
    found = []
    for piece in content.split(b"Tj")[:-1]:
        operand = piece.rstrip()
        begin = operand.rfind(b"(")
        string = operand[begin + 1 : -1]
        if begin >= 0 and operand.endswith(b")") and b")" not in string and len(string) > 1:
            found.append(string)
    return found


def pdf_text(data: bytes) -> str:
    """Shown strings of a PDF, then those of its deflated streams."""
    found = _shown(data)
    for piece in data.split(b"endstream")[:-1]:
        packed = piece.partition(b"stream")[2].removeprefix(b"\r").removeprefix(b"\n")
        try:
            found += _shown(zlib.decompressobj().decompress(packed))
        except zlib.error:  # a stream of another kind
            continue
    return "\n".join(s.decode("latin-1") for s in found)


@F.pandas_udf(T.StringType())
def pdf_text_fallback(data: pd.Series) -> pd.Series:
    return data.map(lambda d: pdf_text(bytes(d)), na_action="ignore")


def json_urls(value, at: str = "$") -> list[tuple[str, str]]:
    """(url, locator) of all web addresses in a JSON tree, sorted, each once."""
    if isinstance(value, dict):
        found = [x for k in value for x in json_urls(value[k], f"{at}.{k}")]
    elif isinstance(value, list):
        found = [x for i, child in enumerate(value) for x in json_urls(child, f"{at}[{i}]")]
    else:
        web = isinstance(value, str) and value == value.strip() and value.casefold().startswith(("http://", "https://"))
        found = [(value, at)] if web else []
    return sorted(set(found))


_FOUND = T.StructType([T.StructField("url", T.StringType()), T.StructField("locator", T.StringType())])


def _walk(text) -> list[dict]:
    try:
        return [{"url": u, "locator": a} for u, a in json_urls(json.loads(text))] if isinstance(text, str) else []
    except ValueError:
        return []


@F.pandas_udf(T.ArrayType(_FOUND))
def json_url_walk(text: pd.Series) -> pd.Series:
    return text.map(_walk)
