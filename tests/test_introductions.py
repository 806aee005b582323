import pytest

from lodestrata.functions import introductions as i
from lodestrata.functions import urls
from lodestrata.operators import extract

CASES = [
    ("A plan", "We propose a lean network architecture, the PrismFormer-X, built on attention mechanisms.", "paper", [("PrismFormer-X", 0.76)]),
    ("A plan", "We name our neural network TideNet-2. It forecasts tides.", "paper", [("TideNet-2", 0.78)]),
    ("A plan", "We refer to the deep neural model as KelpNet, for short.", "paper", [("KelpNet", 0.78)]),
    ("A plan", "Our deep neural network, KelpNet-4, maps kelp.", "paper", [("KelpNet-4", 0.76)]),
    ("A plan", "WaveOp-1, a neural operator for long waves, is tested.", "paper", [("WaveOp-1", 0.72)]),
    ("A plan", "Wave, a neural operator for long waves, is tested.", "paper", []),
    ("A plan", "Here, we built “reef map finder”, a deep neural network for reefs.", "paper", [("reef map finder", 0.80)]),
    ("A plan", "In this study, we present Coastal Orbit Passing Network, a neural network for coasts.", "paper", [("Coastal Orbit Passing Network", 0.78)]),
    ("Reef Graph Potential Network: a deep-learning model of reefs", "", "paper", [("Reef Graph Potential Network", 0.66)]),
    ("Tidal Neural Operator for odd coasts", "We train a neural operator.", "paper", [("Tidal Neural Operator", 0.64)]),
    ("A Deep Neural Network for coasts", "We train a deep neural network.", "paper", []),
    ("TideFold 3 predicts tides", "TideFold 3 is a deep learning system.", "paper", [("TideFold 3", 0.64)]),
    ("MistDiff: sampling", "We introduce MistDiff, a generative diffusion model of mist.", "paper", [("MistDiff", 0.66)]),
    ("A plan", "We introduce SandFlow-X, a physical diffusion model. Apart from it we train a deep neural network as a control.", "paper", []),
    ("A plan", "We introduce SandNet-3 for dunes. SandNet-3 is a deep neural network.", "paper", [("SandNet-3", 0.78)]),
    ("A plan", "We introduce SandNet-3 for dunes. Dunes are met with a deep neural network.", "paper", []),
    ("A plan", "We train a deep neural network on a cohort called DuneSet-X.", "paper", []),
    ("A plan", "We propose a simple approach for dunes.", "paper", []),
    ("o/r", "Code.\n\n# DuneNet-4\n\nA deep neural network for dunes.", "code_repository", [("DuneNet-4", 0.70)]),
    ("o/r", "# DuneTool\n\nTools for tables.", "code_repository", []),
    ("o/r", "This work presents DuneForge-9, a new surrogate. It is a deep neural network.", "code_repository", [("DuneForge-9", 0.78)]),
    ("A plan", "We released GPT3.5-like 2.0 as a deep neural model.", "paper", [("GPT3.5-like 2.0", 0.78)]),
]


@pytest.mark.parametrize(("title", "body", "kind", "expected"), CASES)
def test_forms(title, body, kind, expected):
    found = i.introduced(title, body, kind)
    assert [(n, c) for n, _, c, _ in found] == expected
    for name, _, _, locator in found:
        field, a, b = locator.split(":")
        assert {"title": title, "text": body}[field][int(a) : int(b)] == name


def test_odd_texts():
    for text in ("", " ", "\n\n", "We introduce", "we introduce ", "We introduce X" * 3000, "a " * 50_000, "“”", "," * 100):
        assert i.introduced(text, text, "paper") == i.introduced(text, text, "paper")
    assert i.sentences("A 1.5 b. C!\nD") == [(0, 8), (8, 11), (11, 12), (12, 13)]


def test_links_bring_titles_into_scope(spark):
    rows = [(1, "KelpFold: a map", "", "paper", [("https://hub.test/o/Kelp_Fold", "model_card")]), (2, "KelpFold: a map", "", "paper", [("https://hub.test/o/other", "weights")]), (3, None, None, None, None)]
    df = spark.createDataFrame(rows, "id int, title string, text string, kind string, links array<struct<url:string,relation:string>>")
    assert [(r["id"], r["name"]) for r in extract.extract_intro_cues(df, "id").collect()] == [(1, "KelpFold")]
    assert extract.extract_intro_cues(df.drop("links"), "id").count() == 0


RELATIONS = [
    ("The source code is available at {}", "implementation"), ("Our code repository: {}", "implementation"), ("It was released in our repository {}", "implementation"), ("({}) repository of the paper", "implementation"), ("See {} - the official codebase", "implementation"),
    ("The official repository is {}", "official_implementation"), ("An official implementation. See {}", "embedded"), ("Trained weights are at {}", "weights"), ("checkpoints, all of them: {}", "weights"), ("read the model card at {}", "model_card"),
    ("The implementation is hard. Read {}", "embedded"), ("we talk about {}", "embedded"), ("The implementation of this is found by all who look for it here {}", "embedded"), ("{}", "embedded"),
]


@pytest.mark.parametrize(("said", "expected"), RELATIONS)
def test_relations(said, expected):
    text = said.format("https://x.test/y")
    at = text.index("https")
    assert urls.relation_of(text, at, at + 16) == expected


def test_mentions_skip_impossible_ports():
    assert list(urls.mentions("paper https://docs.example/page http://h.test:port/x")) == [("https://docs.example/page", 6, 31)]
