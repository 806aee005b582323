import random

from lodestrata.llm import boilerplate as b
from lodestrata.llm import truncation as t

STARTS = ["The", "Our new", "A", "In short, the", "Each", "Every small", "This", "That old", "Some say the", "One", "No", "Even the"]
SCHEMA = "doc_id long, text string, source string, source_url string, lang string, reason string"


def corpus(seed=4):
    rng = random.Random(seed)
    nouns = ["model", "paper", "result", "method", "corpus", "table", "report", "score"]
    word = lambda: "".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(3))
    rows, cut = [], set()
    for i in range(900):
        lines = []
        for _ in range(rng.randrange(3, 7)):
            kind = rng.random()
            lines.append(f"- {rng.choice(nouns)} {rng.choice(nouns)}" if kind < 0.3 else f"{rng.choice(STARTS)} {rng.choice(nouns)} {word()} of {word()} shows how {word()} and {word()} change the {rng.choice(nouns)} when {word()} is {word()} enough.")
        text, source = "\n".join(lines), f"s{i % 6}"
        if source == "s0" and len(text) > 150:
            text = text[:150]
            cut.add(i)
        elif i % 10 == 3:
            end = text.rfind(" of ") + 8 + rng.randrange(60)
            if text.rfind(" of ") >= 0 and end < len(text) - 3 and text.rfind("\n", end) < 0 and not text[:end].rstrip().endswith("."):
                text = text[:end]
                cut.add(i)
        rows.append((i, text, source, f"https://{source}.test/{i}", "en", "clash"))
    for n in range(12):  # near-copies
        words = [word() for _ in range(120)]
        full = " ".join(words) + "."
        rows.append((5000 + 2 * n, full, "s5", f"https://s5.test/f{n}", "en", ""))
        rows.append((5001 + 2 * n, " ".join(words[:108]) + ".", "s4", f"https://s4.test/c{n}", "en", ""))
        cut.add(5001 + 2 * n)
    return rows, cut


def test_cut_texts(spark):
    rows, cut = corpus()
    df = spark.createDataFrame(rows, SCHEMA)
    found = t.truncated(df)
    reasons = {r["doc_id"]: r["reason"] for r in found.collect()}
    assert len(cut & set(reasons)) >= 0.93 * len(cut) and len(cut & set(reasons)) >= 0.93 * len(reasons)
    assert sum(reasons.get(5001 + 2 * n) == "copy" for n in range(12)) >= 11
    assert {"limit", "closing", "copy"} <= set(reasons.values())
    rates = {r["source"]: (r["records"], r["cut"]) for r in t.truncation_rates(df, found).collect()}
    assert rates["s0"][0] == 150 and sum(c for _, c in rates.values()) == len(reasons)


def test_odd_texts(spark):
    rows, _ = corpus(5)
    odd = [(9001, None, "s1", None, None, ""), (9002, "", None, None, None, ""), (9003, " \n ", "s1", "x", "en", ""), (9004, "Wholly fine.", None, None, None, ""), (9005, "cut charact�", "s1", None, None, ""), (9006, "word " * 30_000 + "end.", "s1", None, None, ""), (9005, "cut charact�", "s1", None, None, "")]
    found = [r["doc_id"] for r in t.truncated(spark.createDataFrame(rows + odd, SCHEMA)).collect()]
    assert len(found) == len(set(found)) and 9005 in found and not {9001, 9002, 9003, 9004, 9006} & set(found)
    assert t.truncated(spark.createDataFrame([], SCHEMA)).count() == 0


def test_ends_early():
    words = [f"w{i}" for i in range(100)]
    assert t.ends_early(words[:90], words) and t.ends_early(words[:90] + ["w9"], words)
    assert not t.ends_early(words, words) and not t.ends_early(words[:99] + ["w99"], words) and not t.ends_early([f"x{i}" for i in range(90)], words)


def copies(spark, texts):
    """doc_ids found as copies; texts end in a full stop unless cut, and their sources have no length limit."""
    rows = [(i, text, f"s{i}", f"https://s{i}.test/{i}", "en", "") for i, text in enumerate(texts)]
    return {r["doc_id"] for r in t.truncated(spark.createDataFrame(rows, SCHEMA)).where("reason = 'copy'").collect()}


def test_every_longer_text_of_a_band_is_a_partner(spark):
    texts, cut = [], set()
    for n in range(6):
        words = [f"v{n}x{i}" for i in range(115)]
        cut.add(len(texts))
        # The copy, its whole, and a longer text that is too far from the copy but shares bands with both.
        texts += [" ".join(words[:96]) + ".", " ".join(words) + ".", " ".join(words + [f"z{n}x{i}" for i in range(12)]) + "."]
    found = copies(spark, texts)
    assert cut <= found and not {i + 2 for i in cut} & found


def test_of_equal_word_counts_the_shorter_is_cut(spark):
    words = [f"v{i}" for i in range(60)]
    whole, part = " ".join([*words, "complete."]), " ".join([*words, "comp"])
    assert copies(spark, [whole, part]) == {1} and copies(spark, [part, whole]) == {0}
    assert not t.ends_early([*words, "other"], [*words, "complete."])


def test_copies_cut_at_every_depth(spark):
    texts, cut = [], set()
    for n in range(27):
        words = [f"v{n}x{i}" for i in range(150)]
        cut.add(len(texts))
        texts += [" ".join(words[: 15 * (1 + n % 9)]) + ".", " ".join(words) + "."]  # 10, 20, ... 90 % are left
    assert copies(spark, texts) == cut


def test_a_hot_group_is_not_paired(spark, monkeypatch):
    """A third of all rows are near-copies: cut at many places, whole with one ending, and whole with endings of their own."""
    words = [f"v{i}" for i in range(200)]
    cut = [" ".join(words[:n]) + "." for n in range(100, 190)]
    own_end = [" ".join([*words[:195], *(f"e{n}x{i}" for i in range(5))]) + "." for n in range(90)]
    whole = [" ".join(words) + ".", " ".join(["Here", *words]) + "."]
    other = [" ".join(f"o{n}x{i}" for i in range(40)) + "." for n in range(360)]
    tried = []
    verified = t._verified
    monkeypatch.setattr(t, "_verified", lambda pairs, bodies: (tried.append(pairs.count()), verified(pairs, bodies))[1])
    assert copies(spark, cut + own_end + whole + other) == set(range(len(cut)))
    members = len(cut) + len(own_end) + 2
    assert sum(tried) < 6 * members < members * members / 8


def test_ends_and_closings_of_any_length():
    long = "word " * 40_000
    assert t.omitted(long + "[ more ]") and t.omitted(long + "(Continued)") and t.omitted("x…") and t.omitted("x\ufffd\ufffd")
    assert not t.omitted(long + "[12]") and not t.omitted("more]") and not t.omitted("")
    assert t.closing(long + "Model") == "~el" and t.closing("a v2") == "v2" and t.closing("of 1,234.5") == "#" and t.closing("12.") == "#." and t.closing("x)") == ")" and t.closing("3D") == "~D" and t.closing("") == ""
    assert t.closing("模" * 100_000) == "模" * 100_000
    assert t.before_dots("and so on...”") == "on" and t.before_dots("...") == "" and t.before_dots("on.") is None
    assert t.ends_sentence("Done.”)") and t.ends_sentence("好。") and not t.ends_sentence("Done") and not t.ends_sentence("")
    lines = ["- " + "Ab cd " * 100, "12) Ab cd", "Ab cd", "abc def ghi", "GPT4 v2 of 3,5 and Élan", "Y. Duces, Luxo, GmbH", long + "Ab", "", "模型 Ab"]
    assert t.forms(lines) == ["* " + "Cx x " * 99 + "Cx x", "* Cx x", "Cx x", "x", "w w x #,# x Cx", "C. Cx, …", "x Cx", "", "模型 Cx"] and t.forms([]) == []


def test_openings_share_their_bands():
    sign = t.Signer()
    words = [f"w{i}" for i in range(200)]
    for size in (12, 13, 19, 20, 36, 99, 150):
        n = t.openings(size - 4)
        (short, whole), stops, tails = sign.bands([words[:size], words])
        assert tails[0] != tails[1] and stops[0] in t.Signer.shingles(words).view("int64")[:-1]
        assert len(short) == (n + 1) * t.BANDS and short[t.BANDS :] == whole[t.BANDS : (n + 1) * t.BANDS]
    assert sign.bands([[], words[:3]])[0][0] == [] and len(sign.bands([words[:3]])[0][0]) == t.BANDS and sign.bands([])[0] == []


def test_pages_are_read_once(spark, tmp_path, monkeypatch):
    """Their lines are told once and kept; the ends and the bodies of near-copies come from there."""
    rows, cut = corpus(6)
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame(rows, SCHEMA).write.parquet(path)
    readers = []
    for module in (b, t):
        monkeypatch.setattr(module, "cut_lineage", lambda df, cut_lineage=module.cut_lineage: (readers.append(df.columns) if any(path in f for f in df.inputFiles()) else None, cut_lineage(df))[1])
    found = {r["doc_id"] for r in t.truncated(spark.read.parquet(path)).collect()}
    assert len(readers) == 1 and len(cut & found) >= 0.93 * len(cut)
