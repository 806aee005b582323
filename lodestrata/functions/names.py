"""Names, ids and hashes. Builtins where they suffice; a pandas UDF only for Unicode folding."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NOT_WORD = re.compile(r"\W+")


def fold_name(value: str) -> str:
    """NFKC, case folded, every run of other than word characters one blank."""
    return _NOT_WORD.sub(" ", unicodedata.normalize("NFKC", value).casefold()).strip()


@F.pandas_udf(T.StringType())
def normalize_name(value: pd.Series) -> pd.Series:
    return value.map(fold_name, na_action="ignore")


def content_hash(value: Column) -> Column:
    return F.sha2(value, 256)


def canonical_json(value: Column) -> Column:
    """Compact JSON of a struct with fields in their order, nulls kept; declare the fields alphabetically."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def _framed(part: Column) -> Column:
    text = F.encode(part, "UTF-8")
    return F.concat(F.unhex(F.lpad(F.hex(F.length(text)), 16, "0")), text)


def stable_id(kind: str, *parts: Column) -> Column:
    """kind, with - for _, and the sha256 of kind and parts, each behind its length in 8 bytes; null if a part is."""
    return F.concat(F.lit(kind.replace("_", "-") + "_"), F.sha2(F.concat(*[_framed(p) for p in (F.lit(kind), *parts)]), 256))


def hash_bucket(key: Column, count: int) -> Column:
    """First 8 bytes of the key's sha256 modulo count."""
    return F.pmod(F.conv(F.substring(F.sha2(key, 256), 1, 16), 16, 10).cast("decimal(20,0)"), F.lit(count).cast("decimal(20,0)")).cast("long")


def corpus_id(value: Column) -> Column:
    """A positive number in ASCII digits as its plain decimal text; null for anything else."""
    digits = F.regexp_replace(value, "^0+", "")
    return F.when(value.rlike("^[0-9]+$") & (digits != ""), digits)


def safe_filename(value: Column) -> Column:
    """No absolute path, backslash or control character, no empty, . or .. segment, at most 1024 characters."""
    segments = F.split(value, "/", -1)
    bad = F.exists(segments, lambda s: s.isin("", ".", ".."))
    return (F.length(value).between(1, 1024) & ~value.startswith("/") & ~value.contains("\\") & ~value.rlike(r"[\x00-\x1f]") & ~bad).alias("safe")


_PHRASE = re.compile(r"[\w.+\-]+(?: [\w.+\-]+){0,9}")


def looks_distinctive(value: str, quoted: bool = False, strong: bool = False) -> bool:
    """Whether a phrase of at most ten words and 140 signs has the typography of a name: quoted, or enough digits and capitals.

    A capital that begins a word counts one, a digit or a capital inside a word two; a name needs one, a strong one two.
    """
    words = value.split()
    if len(value) not in range(2, 141) or not _PHRASE.fullmatch(" ".join(words)) or not re.search(r"[^\W\d_]", value):
        return False
    weight = sum(2 if c.isdigit() or (n and c.isupper()) else int(c.isupper()) for w in words for n, c in enumerate(w))
    return quoted or weight >= 1 + strong


# Words that make no family by themselves, and openings of ordinary headings.
GENERIC_WORDS = frozenset("deep neural network networks model models operator operators architecture architectures".split())
OPENINGS = ("a ", "an ", "the ", "this ", "that ")


def looks_title_family(value: str) -> bool:
    """Whether a phrase names a family: it has a word of its own and does not open like an ordinary heading."""
    low = value.strip().casefold()
    return not f"{low} ".startswith(OPENINGS) and bool(set(low.split()) - GENERIC_WORDS)
