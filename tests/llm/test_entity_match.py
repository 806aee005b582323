import random

import pytest
from pyspark.sql import functions as F

from lodestrata.llm import entity_match
from lodestrata.llm.model_names import read_name, read_size

NAMES = [
    ("Ruhosi Ihiran v2 350M Chat", "ruhosiihiran", "2", 350_000_000, "chat"), ("code roxivozejum (34b, v1.5)", "roxivozejum", "1.5", 34_000_000_000, "code"), ("vesodapamanV27B", "vesodapaman", "2", 7_000_000_000, ""),
    ("pekotimizilv1.5350mchat", "pekotimizil", "1.5", 350_000_000, "chat"), ("owner/Foba_1.3B_inst.", "foba", "", 1_300_000_000, "instruct"), ("Cucidifepos II 13bn", "cucidifepos", "2", 13_000_000_000, ""),
    ("Ｖｅｓｏ version 3.0 70 billion VL", "veso", "3", 70_000_000_000, "vision"), ("Hаxi​tin-7B", "haxitin", "", 7_000_000_000, ""), ("Nímü-34B-Base", "nimu", "", 34_000_000_000, "base"), ("Solofinover 350M", "solofinover", "", 350_000_000, ""),
]
SIZES = frozenset((350_000_000, 1_300_000_000, 3_000_000_000, 7_000_000_000, 13_000_000_000, 34_000_000_000, 70_000_000_000))


@pytest.mark.parametrize(("name", "core", "version", "size", "tuning"), NAMES)
def test_names(name, core, version, size, tuning):
    assert tuple(read_name(name, SIZES))[:4] == (core, version, size, tuning)


def test_sizes():
    assert [read_size(x) for x in ("7B", "7 billion", "7.0e+09", "7000M", "7000000000", "350M params", "", None, "big", "5")] == [7 * 10**9] * 5 + [350 * 10**6, None, None, None, None]


def corpus(n):
    rng = random.Random(11)
    core = lambda: "".join(rng.choice("bcdfgklmnprstvxz") + rng.choice("aeiou") for _ in range(5)) + "s"
    models, aliases, true = [], [], set()
    for i in range(n):
        name, size, tuning, version = core().title(), rng.choice([7, 13, 70]), rng.choice(["Base", "Chat", ""]), rng.choice(["v2", "v3", ""])
        for extra in range(rng.choice([1, 1, 3])):
            models.append((f"m{i}", " ".join(x for x in (name, version, f"{size}B", tuning) if x), size * 10**9, "Some Labs", "text"))
        models.append((f"r{i}", " ".join(x for x in (name, version, f"{size + 1}B", tuning) if x), (size + 1) * 10**9, "Some Labs", "text"))
        if rng.random() < 0.8:
            at = rng.randrange(2, len(name) - 2)
            typo = rng.choice([name, name[:at] + name[at + 1 :], name[:at] + "z" + name[at:], name.upper()])
            aliases.append((f"a{i}", "_".join(x for x in (typo, version, f"{size}bn", {"Chat": "conv"}.get(tuning, tuning)) if x), rng.choice([f"{size} billion", None]), rng.choice(["some-labs", "SL", None]), rng.choice(["text", "audio", None])))
            aliases.append((f"a{i}", name, f"{size}B", None, None))
            true.add((f"m{i}", f"a{i}"))
        else:
            aliases.append((f"a{i}", f"{name}-{version or 'v2'}-{size + 5}B", None, "Some Labs", None))
    return models, aliases, true


def run(spark, models, aliases):
    m = spark.createDataFrame(models, "id string, name string, size long, owner string, modality string").withColumn("core", F.lit("clash"))
    a = spark.createDataFrame(aliases, "model_id string, alias string, label string, owner string, modality string").withColumn("key", F.lit("clash"))
    return entity_match.match(m, a, our_id="id", our_name=F.col("name"), our_size=F.col("size"), our_owner="owner", their_id="model_id", their_name=F.col("alias"), their_size=F.col("label"), their_owner="owner")


def test_held_out_accuracy(spark):
    models, aliases, true = corpus(150)
    rows = run(spark, models + [(None, "x 7B", 1, None, None), ("n", None, None, None, None)], aliases + [("e", "", None, None, None), (None, "q", None, None, None), ("l", "y" * 5000, None, None, None)]).collect()
    found = {(r["model_id"], r["alias_model_id"]) for r in rows}
    assert len(rows) == len({r["model_id"] for r in rows}) == len({r["alias_model_id"] for r in rows})
    assert len(found & true) >= 0.95 * len(true) and len(found & true) >= 0.97 * len(found)
    assert all(0.5 < r["confidence"] <= 1 for r in rows)


def test_empty(spark):
    models, aliases, _ = corpus(3)
    assert run(spark, models[:0] or [], aliases).count() == 0
    assert run(spark, models, []).count() == 0


def test_owner_likeness():
    like = lambda a, b: entity_match.owner_likeness(entity_match._owner(a), entity_match._owner(b), a or "", b or "")
    assert like("Nizes Labs", "nizes-labs") == like("NL", "Nizes Labs") == like("Nizes", "Nizes Labs") == like("Nizes Lbas", "Nizes Labs") == 1
    assert like("Nizes Labs", "Hezer Institute") == 0 and like(None, "x") == -1


def test_likenesses_are_those_of_each_pair():
    rng = random.Random(5)
    names = ["", "a", "é", "x" * 70, "x" * 69 + "y", *("".join(rng.choice("abcd") for _ in range(rng.randrange(1, 15))) for _ in range(300))]
    a, b = [rng.choice(names) for _ in range(3000)], [rng.choice(names) for _ in range(3000)]
    assert entity_match.likenesses(a, b).tolist() == pytest.approx([entity_match.likeness(x, y) for x, y in zip(a, b)])
    assert entity_match.likenesses([], []).tolist() == [] and entity_match.likenesses(["ab"], ["ba"])[0] == 0.5


def matcher(spark, models, aliases):
    m = spark.createDataFrame(models, "id string, name string, size long, owner string, modality string")
    a = spark.createDataFrame(aliases, "model_id string, alias string, label string, owner string, modality string")
    return entity_match.Matcher(m, a, our_id="id", our_name=F.col("name"), our_size=F.col("size"), our_owner="owner", their_id="model_id", their_name=F.col("alias"), their_size=F.col("label"), their_owner="owner")


def test_candidates_disagree_and_labels_come_from_unseen_rows(spark):
    models, aliases, _ = corpus(150)
    exact = {i: n for i, n, *_ in models}
    aliases += [(k, exact["m" + k[1:]], None, None, None) for k in sorted({a[0] for a in aliases}) if int(k[1:]) % 2]
    models += [(f"v{i}", n.replace("B", "B v5", 1) if " v" not in n else n.replace(" v", " v1.", 1), s, o, m) for i, (_, n, s, o, m) in enumerate(models)]
    made = matcher(spark, models, aliases)
    seen = made.candidates(made.other).agg(*[F.sum(f"{c}_other").alias(c) for c in ("size", "version", "tuning")]).first()
    assert seen["size"] > 0
    p, y = made.classifier.held_out
    assert len(y) >= 20 and y.mean() > 0
    assert abs(p - y).mean() < 0.1 and made.classifier.calibration()


def test_few_labels_take_no_other_path():
    import numpy as np

    none = entity_match.Classifier(np.zeros((0, len(entity_match.FEATURES))), np.zeros(0))
    assert none.weights.tolist() == entity_match.Classifier.START.tolist() and none.calibration() == []
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2, (40, len(entity_match.FEATURES))).astype(float)
    some = entity_match.Classifier(x, x[:, 3])
    assert some.weights[4] > none.weights[4]


def test_a_hot_kind(spark):
    """A third of all rows are one model under ids of their own: paired in turn, whole."""
    models = [(f"h{i}", "Velito v2 7B Chat", 7 * 10**9, "Some Labs", "text") for i in range(80)] + [(f"m{i}", f"Kori{chr(97 + i % 26)}{chr(97 + i // 26)}nozu v3 13B Base", 13 * 10**9, None, None) for i in range(100)]
    aliases = [(f"x{i}", "velito_v2_7b_conv", "7B", None, None) for i in range(120)]
    rows = run(spark, models, aliases).collect()
    assert len(rows) == 80 == len({r["model_id"] for r in rows}) == len({r["alias_model_id"] for r in rows})
