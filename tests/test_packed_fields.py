import pytest

from lodestrata.operators.packed_fields import Segmenter, split_packed

KNOWN = ["Materials, energy", "3D / graphics", "R&D tooling", "Audio", 'The "F" Group', "Feres and Pabe Partners", "Translation (low-resource, oral)", "Search, retrieval and ranking"]


@pytest.mark.parametrize(
    ("cell", "items"),
    [
        ("Audio, Materials, energy; 3D / graphics", ["Audio", "Materials, energy", "3D / graphics"]),
        ('["Audio", "The \\"F\\" Group"]', ["Audio", 'The "F" Group']),
        ("['Audio', 'Other, thing']", ["Audio", "Other, thing"]),
        ("1) Search, retrieval and ranking 2) Audio", ["Search, retrieval and ranking", "Audio"]),
        ("1. Materials, energy\n2. Audio", ["Materials, energy", "Audio"]),
        ("“Materials, energy”, Unknown one", ["Materials, energy", "Unknown one"]),
        ("Audio | R&D tooling;;", ["Audio", "R&D tooling"]),
        ("Feres and Pabe Partners", ["Feres and Pabe Partners"]),
        ("Audio and Feres and Pabe Partners", ["Audio", "Feres and Pabe Partners"]),
        ("New and Old Trust", ["New and Old Trust"]),
        ("Audio, Audio", ["Audio", "Audio"]),
        ("A, B, and Audio", ["A", "B", "Audio"]),
        ("Translation (low-resource, oral)<br/>Audio", ["Translation (low-resource, oral)", "Audio"]),
        ("Odd (with, comma), Audio", ["Odd (with, comma)", "Audio"]),
        (" - ", []), ("N/A", []), ("", []), (None, []), (",;|", []), ("AUDIO", ["AUDIO"]), ('"He said ""hi""", Audio', ['He said "hi"', "Audio"]),
    ],
)
def test_cells(cell, items):
    assert Segmenter(KNOWN).split(cell) == items


@pytest.mark.parametrize(
    ("cell", "items"),
    [
        ("https://a.test/1/https://b.test/x/a,b;54, https://c.test/d", ["https://a.test/1/https://b.test/x/a,b;54", "https://c.test/d"]),
        ("<https://a.test/x?y=z|w> <https://b.test/q>", ["https://a.test/x?y=z|w", "https://b.test/q"]),
        ('"https://a.test/x","https://b.test/y"', ["https://a.test/x", "https://b.test/y"]),
        ("https://a.test/x and https://b.test/y\n", ["https://a.test/x", "https://b.test/y"]),
    ],
)
def test_links(cell, items):
    assert Segmenter([], links=True).split(cell) == items


def test_operator(spark):
    rows = [(1, "Audio, Materials, energy", "x"), (None, "Audio", "y"), (2, None, None), (3, "z, " * 20_000, "n/a"), (1, "Audio", "a;b")]
    df = spark.createDataFrame(rows, "k long, f string, pos string")
    known = spark.createDataFrame([("f", v) for v in KNOWN] + [(None, "q"), ("f", None)], "field string, item string")
    out = [tuple(r) for r in split_packed(df, "k", ["f", "pos"], known).collect()]
    assert (1, "f", 2, "Materials, energy") in out and (None, "f", 1, "Audio") in out and (1, "pos", 2, "b") in out
    assert sum(r[0] == 3 and r[1] == "f" for r in out) == 20_000 and not any(r[0] == 2 for r in out)
    assert split_packed(df.limit(0), "k", ["f"], known.limit(0)).count() == 0
    with pytest.raises(ValueError):
        split_packed(df, "k", ["f"], known, max_known=3)


def test_frequent_values_extend_the_known(spark):
    rows = [(i, "Sign reading") for i in range(4)] + [(9, "Sign reading & Depth estimation")] + [(20 + i, "Depth estimation") for i in range(4)]
    out = split_packed(spark.createDataFrame(rows, "k long, f string"), "k", ["f"], spark.createDataFrame([], "field string, item string"))
    assert sorted(r["item"] for r in out.where("k = 9").collect()) == ["Depth estimation", "Sign reading"]
