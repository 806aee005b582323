from pyspark.sql import functions as F

from lodestrata.llm import consensus

SCHEMA = "model_row long, id string, status string, confidence double, updated_at string, canonical_name string, k_ string"
ROWS = [
    (1, "a", " Candidate ", 0.5, "2024-01-01T00:00:00Z", "Foo Bar 7B", "x"), (2, "a", "RELEASED", 1.7, "2024-01-01 01:00:00+02:00", "Foo-Bar-7B", "x"), (3, "a", "final?", float("nan"), "9999-12-31T23:59:59Z", "Foo Baz 7B", None),
    (4, "a", None, None, None, None, None), (5, "b", "stub", 0.2, "0001-01-01T00:00:00+00:00", "Solo", None), (6, None, "released", 0.9, None, "x", None), (7, None, "released", 0.9, None, "x", None),
    (8, "c", "stub", 0.3, None, "T " * 3000, None), (8, "c", "stub", 0.3, None, "T " * 3000, None), (9, "d", "", -1.0, "1970-01-01T00:00:00Z", "", None), (10, "d", "n/a", 999.0, "2099-01-01 00:00:00", "  ", None),
]


def ranked(spark, rows):
    df = consensus.credible_instant(spark.createDataFrame(rows, SCHEMA), "updated_at", "instant_")
    c = F.col("confidence")
    ranks = {"status": consensus.status_rank(F.col("status")), "confidence": F.when((c >= 0) & (c <= 1) & ~F.isnan(c), c), "updated_at": F.col("instant_")}
    return df, ranks


def test_best_rows(spark):
    df, ranks = ranked(spark, ROWS)
    out = {(r["id"], r["field"]): r["model_row"] for r in consensus.best_rows(df, "id", "model_row", ranks).collect()}
    assert out == {("a", "status"): 2, ("a", "confidence"): 1, ("a", "updated_at"): 1, ("c", "status"): 8, ("c", "confidence"): 8}
    df, ranks = ranked(spark, ROWS[:0])
    assert consensus.best_rows(df, "id", "model_row", ranks).count() == 0


def test_tie_takes_the_lowest_row(spark):
    df, ranks = ranked(spark, [(n, "t", "stub", 0.5, "2024-01-01T00:00:00Z", "x", None) for n in (9, 3, 5)])
    assert {r["model_row"] for r in consensus.best_rows(df, "id", "model_row", ranks).collect()} == {3}


def test_consensus_picks_the_value_closest_to_the_vote(spark):
    rows = [("a", "Alpha Beta 7B Chat", 1.0), ("a", "alpha-beta-7b chat", 1.0), ("a", "Alpha Gamma 7B Chat", 1.5), ("a", "Alpha Beta 7B", 1.0), ("a", None, 9.0), ("a", " ", 9.0), ("b", "One", 1.0), ("c", None, 1.0), (None, "q", 1.0), ("d", "!!", 1.0), ("d", "??", 2.0), ("e", "x", float("nan"))]
    df = spark.createDataFrame(rows, "k string, v string, w double")
    out = {r["k"]: r["v"] for r in consensus.consensus_values(df, "k", "v", F.col("w")).collect()}
    assert out == {"a": "Alpha Beta 7B Chat", "b": "One", "d": "??"}
    assert consensus.consensus_values(df.limit(0), "k", "v", F.col("w")).count() == 0


def test_alignment():
    assert consensus.align(["a", "b", "c"], ["a", "x", "c"]) == [(3, 0, "c"), (2, 0, "x"), (1, 0, "a")]
    assert (1, 1, "n") in consensus.align(["a", "b"], ["a", "n", "b"])
    assert consensus.distance(["a", "b"], ["b"]) == 1 and consensus.align([], []) == []


LLAMAS = [("a", "Llama 7B", 1.75), ("a", "Llama 2 7B", 1.5), ("a", "Llama Chat 2 7B", 1.5)]


def test_inserted_tokens_are_aligned_with_one_another(spark):
    df = spark.createDataFrame(LLAMAS + [("b", "x y", 1.0), ("b", "!!", 3.0)], "k string, v string, w double")
    assert {r["k"]: r["v"] for r in consensus.consensus_values(df, "k", "v", F.col("w")).collect()} == {"a": "Llama 2 7B", "b": "!!"}


def test_blocks_of_a_hot_key(spark, monkeypatch):
    monkeypatch.setattr(consensus, "BLOCK", 4)
    rows = [("a", f"Llama {'Chat ' * (i % 3 == 0)}2 {i}b", 1.0) for i in range(40)] + [("a", "Llama 2 7b", 5.0), ("a", "Llama 7b", 5.5), *[("b", v, w) for _, v, w in LLAMAS]]
    df = spark.createDataFrame(rows, "k string, v string, w double")
    assert {r["k"]: r["v"] for r in consensus.consensus_values(df, "k", "v", F.col("w")).collect()} == {"a": "Llama 2 7b", "b": "Llama 2 7B"}
