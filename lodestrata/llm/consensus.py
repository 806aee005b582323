"""One surviving record of each duplicate group, field by field (problem 4).

A field survives by one of two policies. Best: the row whose value ranks highest, for fields whose
values are ordered (a status, a confidence, a time). Consensus: for names and other texts, the
group's values are aligned token by token, each against the profile of the heavier ones before it,
every column takes its weighted vote, and the existing value closest to the consensus survives. Keys of
many values are aligned in blocks whose profiles are then aligned, so no hot key is gathered in one task.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.instants import normal_instants
from ..operators.skew import lookup_join
from ..session import cut_lineage

# The statuses in their order.
STATUSES = ("stub", "candidate", "documented", "released")
_TOKENS = re.compile(r"[^\W_]+")
GAP = "\0"
BLOCK = 1000  #: values, or profiles of blocks, that one task aligns for a key


def status_rank(status: Column) -> Column:
    """1 to 4 for a status in any case and with marks around it; null for anything else."""
    word = F.lower(F.regexp_replace(status, r"^[^\p{L}]+|[\s\p{Z}.,;:!\"'“”‘’()\[\]_-]+$", ""))
    rank = F.when(word == STATUSES[0], 1)
    for n, name in enumerate(STATUSES[1:], 2):
        rank = rank.when(word == name, n)
    return rank


def credible_instant(df: DataFrame, value: str, name: str, since: str = "1990", before: str = "2050") -> DataFrame:
    """df with name: the instant of value in a form that sorts, UTC without a zone; null if unreadable, before the year since or from before on."""
    read = normal_instants(df.withColumn("text_", F.col(value)), F.col("text_"), F.lit("UTC"), F.lit("dmy")).drop("text_")
    return read.withColumn(name, F.when((F.col("normal") >= since) & (F.col("normal") < before), F.col("normal"))).drop("normal")


def best_rows(df: DataFrame, key: str, row: str, ranks: Mapping[str, Column]) -> DataFrame:
    """key, field, row: for each key of two or more rows and each field, the row of the highest rank.

    ranks gives a column per field, null where the row's value is unusable (NaN too). On a tie the
    lowest row survives; no row of a field whose values are all unusable. Rows with a null key or row
    are left out, repeated rows count as rows. An empty table gives none.
    """
    used = df.where(F.col(key).isNotNull() & F.col(row).isNotNull()).select(F.col(key).alias("k_"), F.col(row).alias("r_"), *[c.alias(f"f{i}") for i, c in enumerate(ranks.values())])
    picks = [F.max_by("r_", F.when(F.col(f"f{i}").isNotNull(), F.struct(F.col(f"f{i}"), -F.col("r_")))).alias(f"w{i}") for i in range(len(ranks))]
    best = used.groupBy("k_").agg(F.count("*").alias("n_"), *picks).where("n_ >= 2")
    listed = best.select("k_", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"w{i}").alias("row")) for i, f in enumerate(ranks)])).alias("x"))
    return listed.where("x.row is not null").select(F.col("k_").alias(key), "x.field", F.col("x.row").alias(row))


def tokens(text: str) -> list[str]:
    return _TOKENS.findall(text.casefold())


def align(anchor: list[str], other: list[str]) -> list[tuple[int, int, str]]:
    """(place, extra, token) of other against anchor: place n, extra 0 is the anchor's token n, extra above 0 stands behind it.

    A token of the anchor that other lacks gives GAP. Global alignment: match 0, change, gap 1.
    """
    rows, columns = len(anchor) + 1, len(other) + 1
    cost = [[i + j if not i or not j else 0 for j in range(columns)] for i in range(rows)]
    for i in range(1, rows):
        for j in range(1, columns):
            cost[i][j] = min(cost[i - 1][j - 1] + (anchor[i - 1] != other[j - 1]), cost[i - 1][j] + 1, cost[i][j - 1] + 1)
    out, i, j = [], rows - 1, columns - 1
    pending: list[str] = []
    while i or j:
        if i and j and cost[i][j] == cost[i - 1][j - 1] + (anchor[i - 1] != other[j - 1]):
            out += [(i, n, t) for n, t in enumerate(reversed(pending), 1)] + [(i, 0, other[j - 1])]
            pending = []
            i, j = i - 1, j - 1
        elif i and cost[i][j] == cost[i - 1][j] + 1:
            out += [(i, n, t) for n, t in enumerate(reversed(pending), 1)] + [(i, 0, GAP)]
            pending = []
            i -= 1
        else:
            pending.append(other[j - 1])
            j -= 1
    return out + [(0, n, t) for n, t in enumerate(reversed(pending), 1)]


def distance(a: list[str], b: list[str]) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def merge_profiles(first: list[dict[str, float]], other: list[dict[str, float]]) -> list[dict[str, float]]:
    """The columns of two profiles aligned; a column has the weight of each of its tokens, GAP among them.

    Global alignment: two columns cost the share of their votes that differ, a column beside no other
    the share that is no gap. On equal costs columns are matched, then those of first come first.
    """
    if not first or not other:
        alone = first or other
        return [dict(c) for c in alone]
    whole, added = sum(first[0].values()), sum(other[0].values())
    left = [1 - c.get(GAP, 0.0) / whole for c in first]
    right = [1 - c.get(GAP, 0.0) / added for c in other]
    change = [[1 - sum(w * d.get(t, 0.0) for t, w in c.items()) / (whole * added) for d in other] for c in first]
    rows, columns = len(first) + 1, len(other) + 1
    cost = [[0.0] * columns for _ in range(rows)]
    for i in range(1, rows):
        cost[i][0] = cost[i - 1][0] + left[i - 1]
    for j in range(1, columns):
        cost[0][j] = cost[0][j - 1] + right[j - 1]
    for i in range(1, rows):
        for j in range(1, columns):
            cost[i][j] = min(cost[i - 1][j - 1] + change[i - 1][j - 1], cost[i - 1][j] + left[i - 1], cost[i][j - 1] + right[j - 1])
    out, i, j = [], rows - 1, columns - 1
    while i or j:
        if i and j and cost[i][j] == cost[i - 1][j - 1] + change[i - 1][j - 1]:
            i, j = i - 1, j - 1
            column = dict(first[i])
            for t, w in other[j].items():
                column[t] = column.get(t, 0.0) + w
        elif j and cost[i][j] == cost[i][j - 1] + right[j - 1]:
            j -= 1
            column = dict(other[j])
            column[GAP] = column.get(GAP, 0.0) + whole
        else:
            i -= 1
            column = dict(first[i])
            column[GAP] = column.get(GAP, 0.0) + added
        out.append(column)
    return out[::-1]


def agreed_tokens(profile: list[dict[str, float]]) -> list[str]:
    """The heaviest token of each column, the higher one on a tie (so a token before a gap); gaps are left out."""
    tops = [max(c.items(), key=lambda x: (round(x[1], 9), x[0]))[0] for c in profile]
    return [t for t in tops if t != GAP]


_PROFILE = T.ArrayType(T.MapType(T.StringType(), T.DoubleType()))


def _aligned(frame: pd.DataFrame) -> pd.DataFrame:
    """One profile of the profiles of a block, the heaviest first. Values without a token have an empty one: a gap in every column."""
    frame = frame.sort_values(["w_", "v_"], ascending=False)
    profile, whole = [], 0.0
    for weight, columns in zip(frame["w_"], frame["p_"]):
        other = [dict(c) for c in columns]
        if profile and other:
            profile = merge_profiles(profile, other)
        elif profile:
            profile = [c | {GAP: c.get(GAP, 0.0) + weight} for c in profile]
        elif other:
            profile = [c | {GAP: c.get(GAP, 0.0) + whole} for c in other] if whole else other
        whole += weight
    return pd.DataFrame({"k_": [frame["k_"].iloc[0]], "v_": [frame["v_"].iloc[0]], "w_": [whole], "p_": [profile]})


@F.pandas_udf(_PROFILE)
def _single(value: pd.Series, weight: pd.Series) -> pd.Series:
    return pd.Series([[{t: w} for t in tokens(v)] for v, w in zip(value, weight)])


@F.pandas_udf(T.ArrayType(T.StringType()))
def _agreed(profiles: pd.Series) -> pd.Series:
    return pd.Series([agreed_tokens([dict(c) for c in p]) for p in profiles])


def _consensus(votes: DataFrame) -> DataFrame:
    """k_, c_: the tokens that the values of each key agree on, of votes (k_, v_, w_, n_)."""
    kind = dict(votes.dtypes)["k_"]
    profiles = votes.select("k_", "v_", "w_", "n_", _single("v_", "w_").alias("p_"))
    most = votes.agg(F.max("n_")).first()[0] or 0
    while True:
        # A key of at most BLOCK values is aligned as a whole, the heaviest first; others in blocks by hash, then the blocks.
        blocks = F.ceil(F.col("n_") / BLOCK)
        parts = profiles.withColumn("b_", F.pmod(F.xxhash64("v_"), blocks))
        met = parts.groupBy("k_", "b_").applyInPandas(_aligned, f"k_ {kind}, v_ string, w_ double, p_ {_PROFILE.simpleString()}")
        if most <= BLOCK:
            return met.select("k_", _agreed("p_").alias("c_"))
        met = cut_lineage(met)
        profiles = lookup_join(met, met.groupBy("k_").agg(F.count("*").alias("n_")), ["k_"])
        most = profiles.agg(F.max("n_")).first()[0]


@F.pandas_udf(T.IntegerType())
def _distance(value: pd.Series, consensus: pd.Series) -> pd.Series:
    return pd.Series([distance(tokens(v), [] if c is None else list(c)) for v, c in zip(value, consensus)], dtype="int32")


def consensus_values(df: DataFrame, key: str, value: str, weight: Column) -> DataFrame:
    """key, value: for each key the existing value closest to the weighted token consensus of its values.

    Null and blank values do not vote, nor do rows of null, non-positive or NaN weight or null key; a
    key without a vote gives no row. Ties: the heavier value, then the lower by text. A value without
    a token (marks only) votes for gaps. Values are aligned whole; keys of over BLOCK distinct values in
    blocks of about as many, each progressively, and then the profiles of the blocks in the same way.
    """
    rows = df.select(F.col(key).alias("k_"), F.trim(F.col(value)).alias("v_"), weight.cast("double").alias("w_"))
    usable = (F.col("v_") != "") & F.col("k_").isNotNull() & (F.col("w_") > 0) & ~F.isnan("w_")
    votes = cut_lineage(rows.where(usable).groupBy("k_", "v_").agg(F.round(F.sum("w_"), 9).alias("w_")))
    anchors = votes.groupBy("k_").agg(F.max_by("v_", F.struct("w_", "v_")).alias("a_"), F.count("*").alias("n_"))
    # A key of one distinct value needs no alignment.
    together = cut_lineage(lookup_join(votes, anchors, ["k_"]))
    agreed = cut_lineage(_consensus(together.where("n_ > 1").select("k_", "v_", "w_", "n_")))
    measured = lookup_join(together.where("n_ > 1"), agreed, ["k_"]).withColumn("d_", _distance("v_", "c_"))
    chosen = measured.groupBy("k_").agg(F.min_by("v_", F.struct("d_", -F.col("w_"), "v_")).alias("v_"))
    single = anchors.where("n_ = 1").select("k_", F.col("a_").alias("v_"))
    return chosen.unionByName(single).select(F.col("k_").alias(key), F.col("v_").alias(value))
