import base64
import random

import pytest

from lodestrata.llm import tokenizer

tiktoken = pytest.importorskip("tiktoken")
PATH = f"{tokenizer.TOKENIZER_DIR}/byte_bpe_50k.tiktoken"


@pytest.fixture(scope="module")
def exact():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=tokenizer.PATTERN, mergeable_ranks=ranks, special_tokens={})


def hard_texts() -> list[str | None]:
    rng = random.Random(5)
    alphabet = list("aab  \n\t'sSté中文😀٣½Ⅷ_-.,;<|>0123​\x1c\x85\xa0　")
    texts = ["", None, " ", "\n\n", "<|endoftext|> x", "don't I'LL we've", "aaaaaaaa" * 400, "ab" * 3000, "x" * 20_001, "한국어 텍스트", "\x1c\x1d hi \x1f"]
    return texts + ["".join(rng.choices(alphabet, k=rng.randrange(1, 60))) for _ in range(800)]


def test_equals_the_public_library(exact):
    texts = hard_texts()
    encode = tokenizer.BatchEncoder(PATH, most_words=500)
    for part in (texts[:100], texts[100:101], [], texts[101:]):
        ids, sizes = encode(part)
        got, at = [], 0
        for n in sizes:
            got.append(ids[at : at + n].tolist())
            at += n
        assert got == [exact.encode_ordinary(t) if t else [] for t in part]
        assert all(exact.decode(g) == (t or "") for g, t in zip(got, part))


def test_operator(spark, exact):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (2, None, None), (3, "", "y"), (None, "z " * 30_000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = tokenizer.encode(df)
    assert out.dtypes == [("doc_id", "bigint"), ("ids", "array<int>")]
    got = sorted((r["doc_id"] or 0, r["ids"]) for r in out.collect())
    assert got == sorted((r[0] or 0, exact.encode_ordinary(r[1]) if r[1] else []) for r in rows)
    assert sorted(r["n_tokens"] for r in tokenizer.count_tokens(df).collect()) == sorted(len(g) for _, g in got)
    assert tokenizer.encode(df.limit(0)).count() == 0
