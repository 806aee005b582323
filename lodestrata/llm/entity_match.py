"""Matching models of two registries that share no key (problem 3).

Names are taken apart (model_names), the rows of an id vote on what it is, and distinct cores of names
meet in bands of a min-hash over their letter triples. A pair of an id and a kind of model (core, version,
size, tuning) is a candidate if, besides the name, all but one of version, size and tuning agree or are
left open; so pairs that differ in one of them are scored, too. A logistic classifier over pairwise
similarities, trained on weak labels and calibrated on held-out ones, gives the probability. Each id
enters one pair at most.

Weak labels come from rows that the features do not see: an id one of whose rows spells the whole name of
exactly one model is known to be it, and its other rows, voting without that one, give the features.

Nothing here pairs ids with ids before the end: cores, and the kinds of one core, are paired as
distinct values, so a name shared by a third of all rows is one value.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import lookup_join
from ..session import cut_lineage
from .model_names import plain, read_name, read_size

BANDS, ROWS = 72, 4  #: of two cores of twelve letters of which two are swapped (similarity 0.56), 0.999 share a band
CLOSE = 0.45  #: similarity by which a pair of cores that share a band is verified; matches are far above it, and what is little above it teaches the classifier
SAMPLE = 5000  #: ids that the classifier's weak labels are drawn from, at most
SALTS = 64
FEATURES = ("close", "exact", "size_same", "size_other", "version_same", "version_other", "tuning_same", "tuning_other", "owner_same", "owner_other", "modality_same", "modality_other")


_SIGNS = re.compile(r"[^a-z0-9.]+")


def _owner(text: str | None) -> str:
    return "".join(c for c in plain(text) if c.isalnum()) if text else ""


def owner_likeness(a: str, b: str, whole_a: str, whole_b: str) -> float:
    """1 for one owner written in two ways (spelling, short form, initials), 0 for two owners, -1 if one is missing."""
    if not a or not b:
        return -1.0
    if a == b or (min(len(a), len(b)) >= 4 and (a.startswith(b) or b.startswith(a))):
        return 1.0
    short, long = (a, whole_b) if len(a) <= len(b) else (b, whole_a)
    initials = "".join(w[0] for w in plain(long).replace("-", " ").split() if w[0].isalnum())
    if short == initials:
        return 1.0
    return 1.0 if likeness(a, b) >= 0.8 else 0.0


def likeness(a: str, b: str) -> float:
    """1 minus the edit distance (with swaps of neighbours) by the longer length."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before, row = before, row, [i] + [0] * len(b)
        for j, y in enumerate(b, 1):
            row[j] = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                row[j] = min(row[j], older[j - 2] + 1)
    return 1.0 - row[-1] / max(len(a), len(b))


def likenesses(first: list[str], second: list[str]) -> np.ndarray:
    """likeness of many pairs, one cell of all their tables at a time; a name of over 64 letters alone."""
    out = np.zeros(len(first))
    lengths = np.array([max(len(a), len(b)) for a, b in zip(first, second)], np.int64)
    for i in np.flatnonzero(lengths > 64):
        out[i] = likeness(first[i], second[i])
    order = np.flatnonzero(lengths <= 64)
    order = order[np.argsort(lengths[order], kind="stable")]
    for start in range(0, len(order), 8192):
        own = order[start : start + 8192]
        sides = []
        for names in (first, second):
            codes = np.zeros((len(own), 66), np.uint32)
            for row, i in enumerate(own.tolist()):
                codes[row, : len(names[i])] = np.frombuffer(names[i].encode("utf-32-le", "surrogatepass"), np.uint32)
            sides.append((codes.T.copy(), np.array([len(names[i]) for i in own.tolist()])))
        (a, long_a), (b, long_b) = sides
        wide = int(long_b.max(initial=0))
        older = before = None
        row = [np.full(len(own), j, np.int16) for j in range(wide + 1)]
        result = np.where(long_a == 0, long_b, 0).astype(np.int16)
        for i in range(1, int(long_a.max(initial=0)) + 1):
            older, before = before, row
            row = [np.full(len(own), i, np.int16)]
            for j in range(1, wide + 1):
                differ = (a[i - 1] != b[j - 1]).astype(np.int16)
                cell = np.minimum(np.minimum(before[j], row[j - 1]) + np.int16(1), before[j - 1] + differ)
                if i > 1 and j > 1:
                    swapped = (a[i - 1] == b[j - 2]) & (a[i - 2] == b[j - 1])
                    cell = np.where(swapped, np.minimum(cell, older[j - 2] + np.int16(1)), cell)
                row.append(cell)
            ended = np.flatnonzero(long_a == i)
            if len(ended):
                result[ended] = np.stack(row)[long_b[ended], ended]
        longest = np.maximum(long_a, long_b)
        out[own] = np.where(longest == 0, 1.0, 1.0 - result / np.maximum(longest, 1))
    return out


def _parsed(df: DataFrame, key: str, name: Column, size: Column, owner: str, modality: str, sizes: frozenset[int]) -> DataFrame:
    """key, spelled, core, version, size, tuning, owner, modality of each row that has a key and a name; spelled is the plain name, its signs one blank."""
    rows = df.select(F.col(key).cast("string").alias("key"), name.alias("name"), size.cast("string").alias("size"), F.col(owner).alias("owner"), F.col(modality).alias("modality")).where("key is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, label in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                meant = read_size(label)
                n = read_name(text, sizes, meant) if text else None
                core = n.core if n and n.core else None
                told = n is not None and not n.bare
                out.append((" ".join(_SIGNS.sub(" ", plain(text)).split()) if core else None, core, n.version if told else None, meant or (n.size if n else None), n.tuning if told else None))
            columns = list(zip(*out)) if out else [[]] * 5
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays, batch.column(3), batch.column(4)], ["key", "spelled", "core", "version", "size", "tuning", "owner", "modality"])

    return rows.mapInArrow(run, "key string, spelled string, core string, version string, size long, tuning string, owner string, modality string").where("core is not null")


def _voted(parsed: DataFrame, keys: list[str], fields: tuple[str, ...] = ("version", "size", "tuning", "owner", "modality")) -> DataFrame:
    """keys and fields: what most rows of a key say, of equals the lower; null where none says anything.

    Votes are counted per distinct value first, so neither many rows nor many values of a key meet in one task's memory.
    """
    kinds = dict(parsed.dtypes)
    cast = parsed.select(*keys, F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])).alias("x")).select(*keys, "x.*")
    votes = cast.groupBy(*keys, "field", "value").agg(F.count("*").alias("n"))
    order = F.struct(-F.col("n"), "value")
    picks = [F.min_by("value", F.when((F.col("field") == f) & F.col("value").isNotNull(), order)).cast(kinds[f]).alias(f) for f in fields]
    return votes.groupBy(*keys).agg(*picks)


def _bands(cores: DataFrame) -> DataFrame:
    """core, band: the bands of distinct cores, over their letter triples."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        made = np.random.default_rng(31).integers(1, 2**63, (2, BANDS * ROWS), dtype=np.uint64)
        mix = np.random.default_rng(32).integers(1, 2**63, ROWS, dtype=np.uint64) | np.uint64(1)
        for frame in frames:
            out = []
            for core in frame["core"]:
                text = f"^{core}$"
                grams = np.array(sorted({xxhash.xxh3_64_intdigest(text[i : i + 3]) for i in range(max(1, len(text) - 2))}), np.uint64)
                with np.errstate(over="ignore"):
                    least = (grams[:, None] * (made[0] | np.uint64(1)) + made[1]).min(axis=0).reshape(BANDS, ROWS)
                    out.append((least * mix).sum(axis=1, dtype=np.uint64) ^ np.arange(BANDS, dtype=np.uint64))
            yield pd.DataFrame({"core": frame["core"].repeat(BANDS).to_numpy(), "band": np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)})

    # The expansion is spread before it is made: small tables would come in one partition.
    return cores.repartition(int(cores.sparkSession.conf.get("spark.sql.shuffle.partitions"))).mapInPandas(run, "core string, band long")


@F.pandas_udf(T.DoubleType())
def _likeness(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(likenesses(a.tolist(), b.tolist()), dtype="float64")


@F.pandas_udf(T.DoubleType())
def _owners(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([owner_likeness(_owner(x), _owner(y), x or "", y or "") for x, y in zip(a, b)], dtype="float64")


def _alike(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """core, other, close: pairs of distinct cores (theirs, ours) that share a band and are close."""
    # The planner takes bands for as small as the cores they are made of: they must not be broadcast.
    pairs = _bands(theirs).join(_bands(ours).withColumnRenamed("core", "other").hint("merge"), "band").select("core", "other").distinct()
    return pairs.withColumn("close", _likeness("core", "other")).where(F.col("close") >= CLOSE)


def _features(pairs: DataFrame) -> DataFrame:
    """pairs with the columns of FEATURES; of each attribute, same and other are both 0 where one side says nothing."""
    compared = pairs.withColumn("owners", _owners("owner", "their_owner"))
    for name in ("size", "version", "tuning", "modality"):
        known = F.col(name).isNotNull() & F.col(f"their_{name}").isNotNull()
        same = F.col(name) == F.col(f"their_{name}")
        compared = compared.withColumns({f"{name}_same": (known & same).cast("double"), f"{name}_other": (known & ~same).cast("double")})
    compared = compared.withColumns({"owner_same": (F.col("owners") > 0).cast("double"), "owner_other": (F.col("owners") == 0).cast("double"), "exact": (F.col("close") == 1).cast("double")})
    return compared.fillna(0.0, list(FEATURES))


class Classifier:
    """Logistic regression on FEATURES, calibrated on a held-out half by Platt's method.

    Weights are normally distributed around START, with a spread of 1 / sqrt(STRENGTH): few labels move them a
    little, many decide them. There is no other path for few labels or none.
    """

    #: What a match looks like before any label is seen: constant, then FEATURES.
    START = np.array([-8.0, 8.0, 1.0, 1.0, -4.0, 1.0, -4.0, 1.0, -4.0, 0.5, -0.5, 0.0, 0.0])
    STRENGTH = 0.1

    def __init__(self, features: np.ndarray, labels: np.ndarray):
        half = np.random.default_rng(3).random(len(labels)) < 0.5
        x = np.c_[np.ones(len(labels)), features]
        self.weights = self._fit(x[half], labels[half], self.START, self.STRENGTH)
        score = x[~half] @ self.weights
        self.shift, self.scale = self._fit(np.c_[np.ones(len(score)), score], labels[~half], np.array([0.0, 1.0]), 1.0)
        self.held_out = (1 / (1 + np.exp(-np.clip(self.scale * score + self.shift, -30, 30))), labels[~half])

    @staticmethod
    def _fit(x: np.ndarray, y: np.ndarray, start: np.ndarray, strength: float) -> np.ndarray:
        """Newton's method with a pull towards start."""
        w = start.astype(float).copy()
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            slope = x.T @ (p - y) + strength * (w - start)
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + strength * np.eye(len(w)), slope)
            w -= np.clip(step, -4, 4)
            if np.abs(step).max() < 1e-6:
                break
        return w

    def calibration(self, bins: int = 10) -> list[tuple[float, float, int, float, float]]:
        """(from, to, pairs, mean confidence, share of matches) of the held-out pairs, by confidence."""
        p, y = self.held_out
        at = np.minimum((p * bins).astype(int), bins - 1)
        return [(n / bins, (n + 1) / bins, int((at == n).sum()), float(p[at == n].mean()), float(y[at == n].mean())) for n in range(bins) if (at == n).any()]

    def probability(self) -> Column:
        score = F.lit(float(self.weights[0])) + sum(F.lit(float(w)) * F.col(f) for w, f in zip(self.weights[1:], FEATURES))
        return 1 / (1 + F.exp(-(F.lit(float(self.scale)) * score + F.lit(float(self.shift)))))


WHAT = ("core", "size", "version", "tuning")


class Matcher:
    """The parts of a match that its result and its calibration share."""

    def __init__(self, ours: DataFrame, theirs: DataFrame, *, our_id: str, our_name: Column, our_size: Column, our_owner: str, their_id: str, their_name: Column, their_size: Column, their_owner: str, modality: str = "modality"):
        counts = ours.where(our_size.isNotNull()).groupBy(our_size.cast("long").alias("size")).agg(F.count("*").alias("n"))
        usual = counts.join(F.broadcast(counts.agg(F.sum("n").alias("all"))), F.col("n") >= 0.01 * F.col("all")).select("size")  # a hundred at most
        sizes = frozenset(r[0] for r in usual.collect())
        mine = cut_lineage(_parsed(ours, our_id, our_name, our_size, our_owner, modality, sizes))
        self.other = cut_lineage(_parsed(theirs, their_id, their_name, their_size, their_owner, modality, sizes))
        # Our ids by what they are: distinct (core, size, version, tuning).
        spelled = mine.groupBy("key", "core").agg(F.count("*").alias("n")).groupBy("key").agg(F.max_by("core", F.struct("n", "core")).alias("core"))
        models = cut_lineage(spelled.join(_voted(mine, ["key"]), "key"))
        self.told = models.where("size is not null and version is not null and tuning is not null")
        self.kinds = cut_lineage(_voted(self.told, list(WHAT), ("owner", "modality")))
        # The kinds of one core are as many as its sizes, versions and tunings together.
        self.by_core = cut_lineage(self.kinds.groupBy(F.col("core").alias("other")).agg(F.collect_list(F.struct("size", "version", "tuning", "owner", "modality")).alias("kinds")))
        self.alike = cut_lineage(_alike(self.kinds.select("core").distinct(), self.other.select("core").distinct()))
        self.names = cut_lineage(mine.join(self.told.select("key", *[F.col(c).alias(f"is_{c}") for c in WHAT]), "key").select("spelled", *[f"is_{c}" for c in WHAT]).distinct())
        self.classifier = self._trained()

    def candidates(self, rows: DataFrame) -> DataFrame:
        """key, the kind (core, size, version, tuning) and FEATURES of each candidate of each id, whose rows vote."""
        voted = _their_votes(rows)
        close = rows.select("key", "core").distinct().join(self.alike, "core").groupBy("key", "other").agg(F.max("close").alias("close"))
        near = cut_lineage(close.join(voted, "key"))

        def differs(kind: Column, name: str) -> Column:
            return F.coalesce((kind[name] != F.col(f"their_{name}")).cast("int"), F.lit(0))

        # Blocks of name and all but one of the three attributes.
        most = F.filter("kinds", lambda k: differs(k, "size") + differs(k, "version") + differs(k, "tuning") <= 1)
        blocked = lookup_join(near, self.by_core, ["other"], how="inner").withColumn("kind", F.explode(most))
        return _features(blocked.select("key", F.col("other").alias("core"), "close", "kind.*", *[c for c in voted.columns if c != "key"]))

    def _trained(self) -> Classifier:
        """From at most SAMPLE ids: each has a row that spells the whole name of one model, and other rows."""
        sole = self.names.groupBy("spelled").agg(F.count("*").alias("n"), *[F.first(f"is_{c}").alias(f"is_{c}") for c in WHAT]).where("n = 1").drop("n")
        exact = self.other.join(sole, "spelled").select("key", "spelled", *[f"is_{c}" for c in WHAT]).distinct()
        known = exact.groupBy("key").agg(F.count_distinct(*[f"is_{c}" for c in WHAT]).alias("n"), *[F.first(f"is_{c}").alias(f"is_{c}") for c in WHAT]).where("n = 1").drop("n")
        unseen = self.other.join(exact.select("key", "spelled"), ["key", "spelled"], "left_anti").join(known.select("key"), "key", "left_semi")
        chosen = cut_lineage(unseen.select("key").distinct().orderBy(F.xxhash64("key"), "key").limit(SAMPLE))
        own = cut_lineage(unseen.join(chosen, "key", "left_semi"))
        scored = self.candidates(own).join(known, "key")
        same = F.lit(True)
        for c in WHAT:
            same = same & (F.col(c) == F.col(f"is_{c}"))
        # Eight wrong candidates an id are enough, and eight models of other names that agree in all else.
        turn = F.row_number().over(W.partitionBy("key", "label").orderBy(F.xxhash64(*WHAT)))
        near = scored.withColumn("label", same.cast("int")).withColumn("turn", turn).where("label = 1 or turn <= 8")
        some = self.kinds.orderBy(F.xxhash64(*WHAT), *WHAT).limit(SAMPLE)
        spelled = own.groupBy("key").agg(F.min("core").alias("their_core")).join(_their_votes(own), "key").join(known, "key")
        agree = [F.col(c) == F.col(f"is_{c}") for c in WHAT[1:]]
        apart = spelled.join(some, agree).where("core <> is_core").withColumn("label", F.lit(0)).withColumn("turn", turn).where("turn <= 8")
        far = _features(apart.withColumn("close", _likeness("their_core", "core")))
        columns = [*FEATURES, "label", F.xxhash64("key").alias("at")]
        rows = near.select(*columns).unionByName(far.select(*columns)).orderBy("at", "label", *FEATURES).limit(SAMPLE * 18).toPandas()
        return Classifier(rows[list(FEATURES)].to_numpy(float).reshape(-1, len(FEATURES)), rows["label"].to_numpy(float))


def _their_votes(rows: DataFrame) -> DataFrame:
    return _voted(rows, ["key"]).withColumnsRenamed({c: f"their_{c}" for c in ("size", "version", "tuning", "owner", "modality")})


def _first(df: DataFrame, most: DataFrame, order: list) -> DataFrame:
    """df with turn, its place among the rows of a kind, of those rows that can come in the first most of it: they are told in SALTS parts first."""
    salted = lookup_join(df, most, list(WHAT), how="inner").withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)))
    local = salted.withColumn("turn", F.row_number().over(W.partitionBy(*WHAT, "salt").orderBy(*order))).where("turn <= most")
    return local.withColumn("turn", F.row_number().over(W.partitionBy(*WHAT).orderBy(*order))).where("turn <= most").drop("most", "salt")


def match(ours: DataFrame, theirs: DataFrame, *, least: float = 0.5, **columns) -> DataFrame:
    """model_id, alias_model_id, confidence: pairs of ids that are one model; each id is in one pair at most.

    columns are those of Matcher. Rows without an id or without a letter in their name say nothing. Rows of
    an id vote; ties go to the lower value. Their ids that leave version, tuning or size open share their
    probability among the models it could be, and pairs of a confidence up to least are left out. Two of
    our ids with equal attributes, or two of theirs, are paired in the order of confidence and id. Empty
    tables give none.
    """
    matcher = Matcher(ours, theirs, **columns)
    scored = matcher.candidates(matcher.other).withColumn("p", matcher.classifier.probability())
    per = scored.groupBy("key").agg(F.max_by(F.struct(*WHAT), F.struct("p", *WHAT)).alias("kind"), F.max("p").alias("p"), F.sum("p").alias("all"))
    chosen = cut_lineage(per.select("key", "kind.*", (F.col("p") / F.greatest(F.lit(1.0), "all")).alias("confidence")).where(F.col("confidence") > least))
    claims = cut_lineage(chosen.groupBy(*WHAT).agg(F.count("*").alias("most")))
    ours_by_kind = cut_lineage(matcher.told.groupBy(*WHAT).agg(F.count("*").alias("most")).join(claims.select(*WHAT), list(WHAT), "left_semi"))
    theirs_in_turn = _first(chosen, ours_by_kind, [F.desc("confidence"), "key"]).withColumnRenamed("key", "alias_model_id")
    ours_in_turn = _first(matcher.told.select("key", *WHAT), claims, ["key"]).withColumnRenamed("key", "model_id")
    return theirs_in_turn.join(ours_in_turn, [*WHAT, "turn"]).select("model_id", "alias_model_id", F.round("confidence", 6).alias("confidence"))


def calibration(ours: DataFrame, theirs: DataFrame, **columns) -> DataFrame:
    """least, most, pairs, confidence, matches: by confidence, how many held-out weak labels are matches. Ten rows at most."""
    rows = Matcher(ours, theirs, **columns).classifier.calibration()
    return ours.sparkSession.createDataFrame(rows, "least double, most double, pairs long, confidence double, matches double")
