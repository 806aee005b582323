import random

import pyarrow as pa

from lodestrata.llm import boilerplate as b
from lodestrata.llm import line_nodes
from lodestrata.session import cut_lineage

SCHEMA = "doc_id long, text string, source_url string, lang string, key string, host string"


def corpus(seed=1, framed_hosts=("one.test", "docs.two.test", "three.test"), plain_hosts=("plain.test", "feed.test"), pages=120):
    """Pages of hosts with templates and without; (rows, lines outside the main body)."""
    rng = random.Random(seed)
    name = lambda: "".join(rng.choice("BCDFG") + rng.choice("aeiou") for _ in range(1)) + "".join(rng.choice("bcdfgklm") + rng.choice("aeiou") for _ in range(4))
    heads = ["Overview", "Results", "Training data"]

    def body(i):
        lines = [f"Notes on {name()}"]
        for k in range(rng.randrange(2, 5)):
            if rng.random() < 0.3:
                lines.append(rng.choice(heads))
            lines.append(f"We measured {name()} against {name()} and found {rng.randrange(999)} of {rng.randrange(999)} cases {'better' if k else 'worse'} than {name()}.")
        return lines

    rows, outside = [], {}
    for host in (*framed_hosts, *plain_hosts):
        site = line_nodes.site_word(host).title()
        for n in range(pages):
            i = len(rows)
            lines, drop = [], set()

            def put(text, chrome):
                lines.append(text)
                if chrome:
                    drop.add(len(lines))

            framed = host in framed_hosts
            if framed:
                put(f"{site}   Home   Models   [Papers]   Contact" if n % 2 else f"{site}   Home   Models   Papers   Contact", True)
                if n % 3 == 0:
                    put(f"{rng.randrange(9999)} downloads", True)
            content = body(i)
            cut = rng.randrange(2, len(content)) if framed and n % 6 == 0 else None
            for k, line in enumerate(content):
                if k == cut:
                    put("Related models", True)
                    put(f"Notes on {name()}", True)
                    put(f"Notes on {name()} ({rng.randrange(99)})", True)
                put(line, False)
            put("", False)
            if framed:
                put(f"© {2020 + n % 4} {site}. All rights reserved.", True)
                put("Back to top", True)
            rows.append((i, "\n".join(lines), f"https://{host}/p/{i}", "en", "clash", "clash"))
            outside[i] = drop
    return rows, outside


def found(spark, rows):
    out = {}
    for r in b.outside_lines(spark.createDataFrame(rows, SCHEMA)).collect():
        out.setdefault(r["doc_id"], set()).add(r["line_no"])
    return out


def test_template_lines_and_links(spark):
    rows, outside = corpus()
    got = found(spark, rows)
    right = sum(len(got.get(i, set()) & d) for i, d in outside.items())
    assert right >= 0.98 * sum(map(len, outside.values()))
    assert right >= 0.98 * sum(map(len, got.values()))


def test_odd_texts(spark):
    rows, _ = corpus(2)
    odd = [(9001, None, "https://one.test/x", "en", "", ""), (9002, "", None, None, "", ""), (9003, " \n\t", "no url", "en", "", ""), (9004, "word " * 40_000, "https://one.test/y", None, "", ""), (None, rows[0][1], rows[0][2], "en", "", ""), rows[0]]
    got = found(spark, rows + odd)
    assert not {9001, 9002, 9003, 9004} & set(got) and got[None] == got[0]
    assert b.outside_lines(spark.createDataFrame([], SCHEMA)).count() == 0


def test_bodies_keep_the_rest(spark):
    rows, outside = corpus(3)
    texts = {r[0]: r[1].split("\n") for r in rows}
    right = 0
    for r in b.main_bodies(spark.createDataFrame(rows, SCHEMA)).where("doc_id % 12 = 1").collect():
        kept = r["body"].split("\n")
        own = [x for n, x in enumerate(texts[r["doc_id"]], 1) if n not in outside[r["doc_id"]]]
        right += own == kept
    assert right >= 48


def test_tree_match_is_the_longest_common_order():
    assert sorted(b.tree_match([1, 2, 3, 4], [1, 3, 2, 4])) in ([1, 2, 4], [1, 3, 4])
    assert b.tree_match([], [1]) == [] and b.tree_match([5, 5], [5, 5]) == [5]


def test_long_template_lines(spark):
    rows, outside = corpus(6)
    notice = "This site uses cookies to keep you signed in, to remember the language you chose and to count visits; by reading on you agree that they are stored on your machine, as the notice on privacy describes in more detail below." * 3
    links = " • ".join(f"Section {w} of the manual" for w in "alpha beta gamma delta epsilon zeta eta theta iota kappa".split())
    framed = [i for i, r in enumerate(rows) if not r[2].startswith(("https://plain", "https://feed"))]
    for i in framed:
        rows[i] = (rows[i][0], rows[i][1] + f"\n{notice}\n{links} • Page {i}a", *rows[i][2:])
    got = found(spark, rows)
    sizes = {i: len(rows[i][1].split("\n")) for i in framed}
    assert len(notice) > 400 and len(links) > 180
    assert sum({sizes[i] - 1, sizes[i]} <= got.get(i, set()) for i in framed) >= 0.98 * len(framed)


def test_hosts_below_the_hot_share(spark):
    """A web of ordinary hosts: none is broadcast, their templates meet their pages in a shuffle."""
    framed = [f"site{n}x.test" for n in range(230)]
    rows, outside = corpus(7, framed, [f"plain{n}x.test" for n in range(60)], 12)
    pages = cut_lineage(b.pages_of(spark.createDataFrame(rows, SCHEMA), "doc_id", "text", "source_url", "lang"))
    wrapper = b.induce(pages)
    assert wrapper.scattered and not wrapper.hosts.where("hot").count()
    got = found(spark, rows)
    right = sum(len(got.get(i, set()) & d) for i, d in outside.items())
    assert right >= 0.95 * sum(map(len, outside.values())) and right >= 0.97 * sum(map(len, got.values()))


def test_a_phrase_of_every_host_is_summed_in_parts(spark):
    """No operator of the plan gathers the rows of one node: there is no window, and groups have the host in their key."""
    rows, _ = corpus(8)
    pages = b.pages_of(spark.createDataFrame(rows, SCHEMA), "doc_id", "text", "source_url", "lang")
    plan = b.induce(pages).hosts._jdf.queryExecution().toString()
    assert "Window" not in plan


def test_lines_in_one_pass_are_lines_one_by_one():
    lines = ["", "  ", "12. Über uns 1,234", "[Home] | Models | Kontakt", "• ONE.test - 3 items", "x" * 5000 + " 17", "模型 卡 3", "a\u00a0b\tc", "Home > Models > Deep", "—  dash"]
    text = "\n".join(lines)
    both = list(line_nodes.LineReader().pages(["one.test", "docs.two.test", ""], pa.array([text, text, text])))
    for page, host in zip(both, ("one.test", "docs.two.test", "")):
        site = line_nodes.site_word(host)
        expected = line_nodes.hashes(pa.array([line_nodes.label(x, site) for x in lines], pa.string())) & ~1
        assert [n for n in page.label if n] == [int(n) for n, x in zip(expected, lines) if x.strip()] and page.text == lines
        assert [bool(n) for n in page.label] == [bool(x.strip()) for x in lines]
    assert both[0].label[4] != both[1].label[4] and both[1].label[4] == both[2].label[4]
    assert sorted(both[0].parts) == [3, 8] and len(both[0].parts[3]) == 3


def test_string_hashes():
    strings = [f"{n}" for n in range(20_000)] + ["", "a", "aa", "aaa", "\0", "\0\0", "é", "z" * 3_000_000, "z" * 3_000_001]
    numbers = line_nodes.hashes(pa.array(strings))
    assert len(set(numbers.tolist())) == len(strings) and numbers.min() >= 0
    assert line_nodes.hashes(pa.array(strings).slice(19_000, 900)).tolist() == numbers[19_000:19_900].tolist()
    assert abs(float((numbers % 2).mean()) - 0.5) < 0.02 and len(line_nodes.hashes(pa.array([], pa.string()))) == 0


def test_wordings_of_marked_and_counted_lines():
    for line, bare in (("12) Notes on Baku (3)", "Notes on Baku"), (" - Notes on Baku ", "Notes on Baku"), ("( Notes on Baku", "Notes on Baku"), ("٣. Notes on Baku", "Notes on Baku"), ("Notes on Baku (1,234) ", "Notes on Baku")):
        assert b.skeleton(line) == b.skeleton(bare) == "C on C"
    assert b.skeleton("(3)") == "" and b.skeleton("Done (3).") == "" and b.skeleton("all of it") == "x of x" and b.skeleton("open models") == "x models" and b.skeleton("") == ""
