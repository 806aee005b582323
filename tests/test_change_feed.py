import datetime as dt
import itertools
import random

from pyspark.sql import functions as F

from lodestrata.operators.change_feed import apply_changes, rejected_changes

FEED = "id string, op string, s long, i long, at timestamp, name string, size string, extra string"
STATE = "id string, s long, gone boolean, name string, size string, k_ string"
T0 = dt.datetime(2026, 1, 1)


def run(spark, state, feed):
    out = apply_changes(
        spark.createDataFrame(state, STATE), spark.createDataFrame(feed, FEED), key="id", fields=["name", "size"], operation=F.col("op"), sequence=F.col("s"), index=F.col("i"),
        delivered=F.col("at"), state_sequence=F.col("s"), state_tombstone=F.col("gone"),
    )
    return {r["id"]: (r["name"], r["size"], r["tombstone"]) for r in out.collect()}


def reference(state, feed):
    """One change after the other."""
    rows = {r[0]: [r[3], r[4], bool(r[2]), r[1] if r[1] is not None else -1] for r in state if r[0] is not None}
    last = {}
    for id_, op, s, i, at, name, size, _ in feed:
        kind = {"i": "w", "insert": "w", "update": "w", "upsert": "w", "patch": "p", "d": "d", "delete": "d", "remove": "d"}.get((op or "").strip().lower())
        if None in (id_, s, i) or kind is None:
            continue
        k = (id_, s, kind == "d", i)
        rank = (at or dt.datetime(1, 1, 1), name is not None, name or "", size is not None, size or "", kind == "p")
        if k not in last or rank > last[k][0]:
            last[k] = (rank, kind, name, size)
    for (id_, s, _, _), (_, kind, name, size) in sorted(last.items(), key=lambda x: x[0][1:]):
        row = rows.setdefault(id_, [None, None, True, -1])
        if s <= row[3] and row[3] >= 0:
            continue
        if kind == "d":
            row[:3] = [None, None, True]
        elif kind == "w":
            row[:3] = [name, size, False]
        else:
            row[:3] = [name if name is not None else row[0], size if size is not None else row[1], False]
    return {k: tuple(v[:3]) for k, v in rows.items()}


def test_against_one_by_one(spark):
    rng = random.Random(7)
    ops = ["I", "update ", "UPSERT", "patch", "D", "remove", "odd", None]
    feed = [
        (rng.choice(["a", "b", "c", None]), rng.choice(ops), rng.choice([1, 2, 3, 4, None]), rng.choice([0, 1, 2]), rng.choice([T0, T0 + dt.timedelta(days=1), None]), rng.choice(["x", "y", None]), rng.choice(["1", None]), "e")
        for _ in range(300)
    ]
    state = [("a", 2, False, "s", "0", "clash"), ("d", 9, True, None, None, None), (None, 1, False, "n", None, None)]
    for chunk in (feed, feed[:40], feed[40:60]):
        assert run(spark, state, chunk) == reference(state, chunk)
        shuffled = chunk[:]
        rng.shuffle(shuffled)
        assert run(spark, state, shuffled) == reference(state, chunk)


def test_empty_and_repeated(spark):
    assert run(spark, [], []) == {}
    assert run(spark, [("a", 1, False, "n", None, None)], []) == {"a": ("n", None, False)}
    row = ("z", "insert", 1, 0, T0, "x" * 100_000, "1", None)
    assert run(spark, [], [row] * 5) == {"z": ("x" * 100_000, "1", False)}
    assert run(spark, [], [("q", "delete", 1, 0, T0, None, None, None)]) == {"q": (None, None, True)}


def test_rejected(spark):
    rows = [("a", "odd", 1, 0, T0, None, None, None), (None, "i", 1, 0, T0, None, None, None), ("a", "i", None, 0, T0, None, None, None), ("a", "i", 1, 0, T0, None, None, None)]
    out = rejected_changes(spark.createDataFrame(rows, FEED), key="id", operation=F.col("op"), sequence=F.col("s"), index=F.col("i")).collect()
    assert sorted(r["reason"] for r in out) == ["no position", "no record id", "unknown operation"]


def test_all_orders_agree(spark):
    feed = [("a", "i", 1, 0, T0, "1", None, None), ("a", "d", 1, 0, T0, None, None, None), ("a", "patch", 2, 0, T0, None, "s", None)]
    for order in itertools.permutations(feed):
        assert run(spark, [], list(order)) == {"a": (None, "s", False)}
