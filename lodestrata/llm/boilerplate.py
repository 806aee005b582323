"""Main body of pages without navigation, notices, sidebars and footers (problem 7).

Wrapper induction over the pages of each host. A page is a tree: the page, its lines, and the segments
of lines that list several things. Neighbouring pages of a host are aligned by simple tree matching;
nodes that keep matching are the host's template, the slots between them vary and are content. Two
things follow from all hosts together: a phrase that recurs on pages with a template, but not on
pages without, is page furniture wherever it stands; and the wordings of titles, learned from the
first lines of pages without a template, tell lists of links under such a phrase from the body.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from operator import lt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import lookup_join
from ..session import cut_lineage
from .line_nodes import MARK, LineReader, Lines

# Words that say how a title is built, not what it is about.
FUNCTION_WORDS = frozenset(
    "a an the on in of for with and to from by at un une una el la le les los las de des du del para pour con avec sur en y et ein eine einen der die das für mit von zu und über im am".split()
)
HOT = 0.005  #: share of the pages from which a host is looked up in a broadcast
MOST_SHIPPED = 2_000_000  #: furniture nodes and title wordings that are sent to every task, at most; more is an error
_CRUMBS = re.compile(r"\s+[>»›/]\s+")
_COUNT = re.compile(r"\s*\(\d[\d.,]*\)$")
_BEFORE_TITLES = "*•·›»>-–—("  #: with digits, what a list mark begins with
_WORD = re.compile(r"[^\W\d_][^\W_]*(?:[-'’][^\W_]+)*|\d+(?:[.,]\d+)*|[:,;?!]")
STOPS, CLOSERS = ".!?…。！？;:,", "'\"”’»)]"  #: fixed values: marks that end a sentence or clause, and those that may follow


def _hash(text: str | bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


class Kinds(dict):
    """What a word counts as in a wording, remembered."""

    def __missing__(self, word: str) -> str:
        if len(self) > 100_000:
            self.clear()
        kind = word if word.lower() in FUNCTION_WORDS or not word[0].isalnum() else "#" if word[0].isdigit() else "C" if word[0].isupper() else "x"
        if len(word) < 100:
            self[word] = kind
        return kind


_kinds = Kinds()


def skeleton(line: str) -> str:
    """How a line is worded: function words, marks, and runs of capital and lower words; empty for sentences."""
    text = line.strip()
    if text[:1] in _BEFORE_TITLES or text[:1].isdigit():
        text = MARK.sub("", text)
    if text[-1:] == ")":
        text = _COUNT.sub("", text)
    if not text or text.rstrip(CLOSERS)[-1:] in tuple(STOPS):
        return ""
    out: list[str] = []
    word = ""
    for word in _WORD.findall(text):
        kind = _kinds[word]
        if not out or out[-1] != kind or kind not in "Cx#":
            out.append(kind)
    if word.islower() and not set(out) - {"C", "x", "#"}:
        out.append(word)  # too plain a wording to tell without its last word
    return " ".join(out)


class Wordings:
    """Hashes of wordings, remembered: template lines come again and again."""

    def __init__(self, most_chars: int = 10_000_000):
        self.most_chars, self.chars, self.memo = most_chars, 0, {}

    def __call__(self, line: str) -> int:
        """Hash of the line's wording; 0 if it is none of a title."""
        if line[-1:] in ".!?:;,…":
            return 0
        found = self.memo.get(line)
        if found is None:
            text = skeleton(line)
            found = _hash(text) if text else 0
            self.chars += len(line)
            if self.chars > self.most_chars:
                self.memo.clear()
                self.chars = len(line)
            self.memo[line] = found
        return found


def tree_match(a: list[int], b: list[int]) -> list[int]:
    """Nodes matched by simple tree matching of two pages in document order; every node counts once, at its first place."""
    place = dict(zip(reversed(b), range(len(b) - 1, -1, -1)))
    sequence = [(place[node], node) for node in dict.fromkeys(a) if node in place]
    if all(map(lt, sequence, sequence[1:])):  # in order throughout, as most are
        return [node for _, node in sequence]
    # Distinct nodes: the largest ordered matching is the longest increasing run of places.
    tops: list[int] = []
    top_at: list[int] = []
    before = [-1] * len(sequence)
    for i, (at, _) in enumerate(sequence):
        k = bisect_left(tops, at)
        before[i] = top_at[k - 1] if k else -1
        if k == len(tops):
            tops.append(at)
            top_at.append(i)
        else:
            tops[k], top_at[k] = at, i
    out, i = [], top_at[-1] if top_at else -1
    while i >= 0:
        out.append(sequence[i][1])
        i = before[i]
    return out


class Page(NamedTuple):
    """The lines of a page as _read_pages tells them: nodes, wording hashes (0 if none of a title), and the segments' nodes by line."""

    text: list[str]
    label: list[int]
    wording: list[int]
    parts: dict[int, list[int]]
    worded: list[int]


def _flat(lists: pa.Array) -> tuple[list, list[int]]:
    """The values of all lists, and where each begins and ends in them."""
    bounds = np.r_[0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]
    return lists.flatten().to_numpy(zero_copy_only=False).tolist(), bounds.astype(np.int64).tolist()


def _segments(batch: pa.RecordBatch) -> list[dict[int, list[int]]]:
    """For each page the nodes of its segments by line."""
    (places, bounds), (nodes, _) = _flat(batch.column("part_at")), _flat(batch.column("part"))
    out: list[dict[int, list[int]]] = []
    for a, b in zip(bounds, bounds[1:]):
        own: dict[int, list[int]] = {}
        for line, node in zip(places[a:b], nodes[a:b]):
            own.setdefault(line, []).append(node)
        out.append(own)
    return out


class Pages:
    """Tells the lines of a page that are not its main body."""

    def __init__(self, furniture: frozenset[int], titles: frozenset[int]):
        self.furniture, self.titles = furniture, titles

    def judged(self, batch: pa.RecordBatch, constants: list[set[int]]) -> Iterator[tuple[Page, list[int], bool]]:
        """Of each page of a batch of read pages: its lines, and what judge says of them."""
        label, bounds = _flat(batch.column("label"))
        wording, worded = (_flat(batch.column(c))[0] for c in ("wording", "worded"))
        for text, a, b, parts, constant in zip(batch.column("text").to_pylist(), bounds, bounds[1:], _segments(batch), constants):
            page = Page(text.split("\n"), label[a:b], wording[a:b], parts, worded[a:b])
            yield page, *self.judge(page, constant)

    def judge(self, page: Page, constant: set[int]) -> tuple[list[int], bool]:
        """Numbers from 1 of the non-blank lines outside the main body, and whether the last line is furniture that breaks off inside its last segment."""
        lines, label, wording, segments, worded = page
        known, titles = self.furniture, self.titles
        size = len(lines)
        chrome = [False] * size
        crumb, ragged, last = "", False, max((i for i in range(size) if label[i]), default=-1)
        for i, own in enumerate(label):
            if not own:
                continue
            if own in constant or own in known or wording[i] in known and worded[i] not in titles:
                chrome[i] = True
                continue
            rest = segments.get(i)
            if rest:
                same = sum(n in constant or n in known for n in rest)
                if same >= 0.6 * len(rest):
                    chrome[i] = True
                    ragged |= i == last and rest[-1] not in constant and rest[-1] not in known
                elif rest[0] in constant:
                    pieces = _CRUMBS.split(lines[i].strip(), maxsplit=2)
                    if len(pieces) > 2:
                        chrome[i], crumb = True, crumb or pieces[-1].strip()
        links = [False] * size
        for i in range(1, size):
            if label[i] and not chrome[i] and (chrome[i - 1] or links[i - 1]):
                links[i] = worded[i] in titles or (lines[i][-1] == ")" and bool(_COUNT.search(lines[i])))
        first = next((i for i in range(size) if label[i] and not (chrome[i] or links[i])), size)
        heads = [i for i in range(first) if links[i] and not _COUNT.search(lines[i].strip()) and not MARK.match(lines[i].strip())]
        if crumb:  # it names the page's title
            heads = [i for i in heads if lines[i].strip().startswith(crumb)]
        if heads and not (first < size and worded[first] in titles):
            links[heads[-1]] = False  # the last title before the body is the page's own
        return [i + 1 for i in range(size) if chrome[i] or links[i]], ragged


def _host(url: str):
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^\s*[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/@\s]*@)?([^/:?#\s]+)", 1)), F.lit(""))


_READ = "label array<long>, wording array<long>, worded array<long>, part_at array<int>, part array<long>, first long, numbered array<long>"


def _read_pages(pages: DataFrame) -> DataFrame:
    """The pages, their host as a number, with label, wording and worded of each line (0 for a blank one), the nodes part of
    their segments and the lines part_at of those, the wording of their first line, and those of lines with a count."""
    kept = [c for c in pages.columns if c != "host"]
    kinds = dict(pages.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, worded = LineReader(), Wordings()
        for batch in batches:
            start = 0
            for read in reader.read(batch.column("name").to_pylist(), batch.column("text")):
                count = len(read.bounds) - 1
                distinct = read.distinct.to_pylist()
                titled = np.array([worded(x) for x in distinct], np.int64)[read.at]
                counted = np.array([x[-1:] == ")" and bool(_COUNT.search(x)) for x in distinct], bool)[read.at]
                counted &= (titled != 0) & pc.ends_with(read.lines, ")").to_numpy(zero_copy_only=False)
                full = np.flatnonzero(read.label)
                head = np.searchsorted(full, read.bounds)
                firsts = np.zeros(count, np.int64)
                some = head[1:] > head[:-1]
                firsts[some] = titled[full[head[:-1][some]]]
                segments = [(line, node) for page in range(count) for line, nodes in sorted(read.parts.get(page, {}).items()) for node in nodes]
                sizes = [sum(map(len, read.parts[page].values())) if page in read.parts else 0 for page in range(count)]
                inside = pa.array(np.r_[0, np.cumsum(sizes)], pa.int32())
                bounds = pa.array(read.bounds, pa.int32())
                listed = lambda values, ends, kind=pa.int64(): pa.ListArray.from_arrays(ends, pa.array(values, kind))
                found = [
                    *(listed(x, bounds) for x in (read.label, read.wording, titled)), listed([x for x, _ in segments], inside, pa.int32()), listed([x for _, x in segments], inside),
                    pa.array(firsts), listed(titled[counted], pa.array(np.r_[0, np.cumsum(counted)][read.bounds], pa.int32())),
                ]
                own = batch.slice(start, count)
                yield pa.RecordBatch.from_arrays([own.column(c) for c in ("host", *kept)] + found, ["host", *kept, "label", "wording", "worded", "part_at", "part", "first", "numbered"])
                start += count

    schema = ", ".join(["host long", *(f"{c} {kinds[c]}" for c in kept), _READ])
    return pages.select(F.xxhash64("host").alias("host"), F.col("host").alias("name"), *kept).mapInArrow(run, schema)


def _nodes(batch: pa.RecordBatch) -> Iterator[list[int]]:
    """The distinct nodes of each page in document order."""
    label, wording = batch.column("label"), batch.column("wording")
    pairs = np.stack([x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in (label, wording)], axis=1).ravel()
    full = pairs != 0
    bounds = np.r_[0, np.cumsum(pc.list_value_length(label).to_numpy(zero_copy_only=False))].astype(np.int64)
    ends = np.r_[0, np.cumsum(full)][2 * bounds].tolist()
    nodes = pairs[full].tolist()
    for row, (parts, a, b) in enumerate(zip(_segments(batch), ends, ends[1:])):
        yield Lines([], label[row].as_py(), wording[row].as_py(), parts).nodes() if parts else list(dict.fromkeys(nodes[a:b]))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """host, lang, node, pages, matched: pre-aggregated over the pages of a task, which come sorted by host."""
    totals: dict[tuple, Counter] = {}
    kept: dict[tuple, Counter] = {}
    at, previous, held = None, [], 0

    def flush() -> pa.RecordBatch:
        sizes = [len(c) for c in totals.values()]
        nodes = [n for c in totals.values() for n in c]
        pages = [v for c in totals.values() for v in c.values()]
        matched = [m[n] for k, c in totals.items() for m in (kept.get(k, Counter()),) for n in c]
        hosts = [k[0] for k, size in zip(totals, sizes) for _ in range(size)]
        langs = [k[1] for k, size in zip(totals, sizes) for _ in range(size)]
        totals.clear()
        kept.clear()
        columns = [pa.array(hosts, pa.int64()), pa.array(langs, pa.string()), pa.array(nodes, pa.int64()), pa.array(pages, pa.int64()), pa.array(matched, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["host", "lang", "node", "pages", "matched"])

    for batch in batches:
        for host, lang, nodes in zip(batch.column("host").to_pylist(), batch.column("lang").to_pylist(), _nodes(batch)):
            key = (host, lang)
            totals.setdefault(key, Counter()).update(nodes)
            if at == host:
                kept.setdefault(key, Counter()).update(tree_match(nodes, previous))
            at, previous = host, nodes
            held += len(nodes)
            if held > 400_000:
                yield flush()
                held = 0
    yield flush()


class Wrapper:
    """The pages as they are read (a table), and what induction finds: constant nodes per host (a DataFrame), furniture and title wordings (bounded sets)."""

    def __init__(self, pages: DataFrame, hosts: DataFrame, furniture: frozenset[int], titles: frozenset[int]):
        self.pages, self.hosts, self.furniture, self.titles = pages, hosts, furniture, titles
        self.scattered = hosts.where("not hot").limit(1).count() > 0


def induce(pages: DataFrame, steady: float = 0.01, rare: float = 0.0005) -> Wrapper:
    """The wrapper of pages (host, lang, spread, text and more), from all of them. They are read once, into its table.

    A node is firm on a host if tree matching keeps it in at least steady of the neighbouring pages. A
    host whose pages keep two firm nodes on average has a template. Its constant nodes are the firm
    ones, unless pages without a template have them nearly as often, and those on a twentieth of its
    pages that pages without a template lack. To lack is to have less than a tenth of what is
    expected by the number of pages, language by language, where at least six are expected. Furniture
    is a node that is on at least rare of the pages with a template, beyond the hosts where it is
    firm, and that pages without one lack. So furniture has at most (nodes a page) / rare
    members, title wordings as many, and a host at most (nodes a page) * 20 constant nodes.
    """
    trees = cut_lineage(_read_pages(pages))
    lang_sizes = cut_lineage(trees.groupBy("host", "lang").agg(F.count("*").alias("lang_size")))
    sizes = lang_sizes.groupBy("host").agg(F.sum("lang_size").alias("size"))
    # Ranges of (host, spread) keep a host's pages together and still split a host that owns much of the data.
    pairs = trees.select("host", "lang", "spread", "label", "wording", "part_at", "part").repartitionByRange("host", "spread").sortWithinPartitions("host", "spread").drop("spread")
    counted = pairs.mapInArrow(_counts, "host long, lang string, node long, pages long, matched long")
    # Grouped by host, too: a phrase of every host has many groups, none of them large. What follows sums them by partial aggregates.
    counts = cut_lineage(counted.groupBy("node", "host", "lang").agg(F.sum("pages").alias("pages"), F.sum("matched").alias("matched")))

    # First the hosts with a template: those whose pages keep matching.
    nodes = counts.groupBy("host", "node").agg(F.sum("pages").alias("pages"), F.sum("matched").alias("matched")).where("pages >= 3 and node % 2 = 0")
    likely = nodes.join(sizes, "host").withColumn("firm", F.col("matched") >= F.greatest(F.lit(2), steady * F.col("size"))).where(F.col("firm") | (F.col("pages") >= 0.05 * F.col("size")))
    likely = cut_lineage(likely)
    kept = likely.groupBy("host").agg((F.sum(F.when(F.col("firm"), F.col("matched"))) / F.max("size")).alias("kept"))
    framed = cut_lineage(kept.where("kept >= 2").select("host", F.lit(True).alias("framed")))

    # What the pages without a template hold, language by language.
    kinds = lang_sizes.join(framed, "host", "left")
    volume = cut_lineage(kinds.groupBy("lang").agg(F.sum(F.when(F.col("framed"), F.col("lang_size")).otherwise(0)).alias("all_on"), F.sum(F.when(F.col("framed"), 0).otherwise(F.col("lang_size"))).alias("all_off")))
    total = volume.agg(F.sum("all_on")).first()[0] or 0
    pages_of_all = F.broadcast(sizes.agg(F.sum("size").alias("pages")))
    hot = cut_lineage(sizes.crossJoin(pages_of_all).where(F.col("size") >= HOT * F.col("pages")).select("host"))  # 1 / HOT hosts at most
    # Only nodes of so many pages can be furniture, and only likely ones constant: the others, most of all, are left out here.
    least = max(1.0, rare * total)
    if least > 1:
        many = counts.groupBy("node").agg(F.sum("pages").alias("pages")).where(F.col("pages") >= least).select("node")
        counts = cut_lineage(counts.join(cut_lineage(many.unionByName(likely.select("node")).distinct()), "node", "left_semi"))
    by_host = cut_lineage(lookup_join(counts, framed, ["host"], hot=hot).withColumn("framed", F.coalesce("framed", F.lit(False))))
    off = by_host.where(~F.col("framed")).groupBy("node", "lang").agg(F.sum("pages").alias("off"))

    # A host's constant nodes are firm ones, and common ones that pages without a template lack.
    shares = by_host.where("framed").join(likely.select("host", "node", "firm"), ["host", "node"]).join(lang_sizes, ["host", "lang"]).join(volume, "lang").join(off, ["node", "lang"], "left")
    judged = shares.groupBy("host", "node").agg(
        F.first("firm").alias("firm"), F.sum(F.col("pages") / F.col("lang_size") * F.col("all_off") * (F.col("pages") / F.col("lang_size") > 0.02).cast("int")).alias("expected"),
        F.sum(F.coalesce("off", F.lit(0))).alias("off"),
    )
    lacking = (F.col("expected") >= 6) & (F.col("off") < 0.1 * F.col("expected"))
    constant = cut_lineage(judged.where(lacking | F.col("firm") & ((F.col("expected") < 6) | (F.col("off") < 0.3 * F.col("expected")))).select("host", "node", "firm"))
    lists = constant.groupBy("host").agg(F.collect_list("node").alias("constant"))
    hosts = cut_lineage(lists.join(sizes, "host").crossJoin(pages_of_all).select("host", "constant", (F.col("size") >= HOT * F.col("pages")).alias("hot")))

    on = by_host.where("framed").join(constant.where("firm"), ["host", "node"], "left_anti").groupBy("node", "lang").agg(F.sum("pages").alias("on"))
    tested = on.join(off, ["node", "lang"], "left").join(volume, "lang").groupBy("node").agg(
        F.sum("on").alias("on"), F.sum(F.coalesce("off", F.lit(0))).alias("off"), F.sum(F.col("on") / F.col("all_on") * F.col("all_off")).alias("expected")
    )
    furniture = tested.where((F.col("on") >= least) & (F.col("expected") >= 6) & (F.col("off") < 0.1 * F.col("expected")))

    plain = trees.join(framed, "host", "left_anti")
    heads = plain.where("first <> 0").groupBy(F.col("first").alias("worded")).agg(F.count("*").alias("head"))
    lines = plain.select(F.explode("worded").alias("worded")).where("worded <> 0").groupBy("worded").agg(F.count("*").alias("lines"))
    starts = plain.count()
    titles = heads.join(lines, "worded").where((F.col("head") >= max(2.0, rare * starts)) & (F.col("head") >= F.col("lines") - F.col("head")))
    # Links are titles, too: wordings that often carry a count in brackets on pages with a template.
    counted = trees.join(framed, "host", "left_semi").select(F.explode("numbered").alias("worded")).groupBy("worded").agg(F.count("*").alias("n"))
    linked = counted.where(F.col("n") >= max(3.0, rare * total))
    return Wrapper(trees, hosts, _shipped(furniture.select("node")), _shipped(titles.select("worded").unionByName(linked.select("worded")).distinct()))


def _shipped(numbers: DataFrame) -> frozenset[int]:
    rows = numbers.limit(MOST_SHIPPED + 1).collect()
    if len(rows) > MOST_SHIPPED:
        raise ValueError(f"over {MOST_SHIPPED} nodes of furniture or wordings: raise the share that makes them")
    return frozenset(r[0] for r in rows)


def pages_of(df: DataFrame, key: str, text: str, url: str, lang: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """key, host, lang, spread, text and the extra columns of the rows that have a text."""
    found = df.select(F.col(key).alias("key"), _host(url).alias("host"), F.coalesce(F.lower(F.col(lang)), F.lit("")).alias("lang"), F.xxhash64(F.col(key)).alias("spread"), F.col(text).alias("text"), *extra)
    return found.where("text is not null")


def outside_lines(df: DataFrame, key: str = "doc_id", text: str = "text", url: str = "source_url", lang: str = "lang") -> DataFrame:
    """key, line_no: the non-blank lines, counted from 1, that are not part of the main body of each page.

    Null, empty and blank texts have none. A page without a host, or of a host too small to align, is
    judged by the furniture of all hosts. Lines and texts of any
    length are read whole; rows with the same key are pages of their own. Other columns are ignored.
    """
    pages = pages_of(df, key, text, url, lang)

    def numbers(judge: Pages, batch: pa.RecordBatch, constants: list[set[int]]) -> Iterator[pa.RecordBatch]:
        take, values = [], []
        for row, (_, found, _) in enumerate(judge.judged(batch, constants)):
            values += found
            take += [row] * len(found)
        yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(take, pa.int32())), pa.array(values, pa.int32())], ["key", "line_no"])

    wrapper = induce(pages)
    return map_pages(wrapper.pages, wrapper, numbers, f"key {dict(pages.dtypes)['key']}, line_no int").withColumnRenamed("key", key)


def map_pages(pages: DataFrame, wrapper: Wrapper, work: Callable[[Pages, pa.RecordBatch, list[set[int]]], Iterator[pa.RecordBatch]], schema: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """work over batches of read pages (wrapper.pages, or some of them) and the extra columns, with the constant nodes of each row's host."""
    furniture, titles = wrapper.furniture, wrapper.titles
    keyed = pages.select("host", "key", "text", "label", "wording", "worded", "part_at", "part", *extra)
    # Hosts of many pages are looked up in a broadcast: at most 1 / HOT of them. Only if others have a template, too, the rest is joined by a shuffle.
    known = wrapper.hosts.select("host", "constant", "hot")
    hot = F.broadcast(known.where("hot").drop("hot"))
    joined = keyed.join(hot, "host", "left")
    if wrapper.scattered:
        rest = keyed.join(F.broadcast(known.where("hot").select("host")), "host", "left_anti").join(known.where("not hot").drop("hot"), "host", "left")
        joined = keyed.join(hot, "host").unionByName(rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Pages(furniture, titles)
        seen: dict[int, set[int]] = {}
        for batch in batches:
            constants, listed = [], batch.column("constant")
            for row, host in enumerate(batch.column("host").to_pylist()):
                if host not in seen:
                    if len(seen) > 1000:
                        seen.clear()
                    seen[host] = set(listed[row].as_py() or ())
                constants.append(seen[host])
            yield from work(judge, batch, constants)

    return joined.mapInArrow(run, schema)


def main_bodies(df: DataFrame, key: str = "doc_id", text: str = "text", url: str = "source_url", lang: str = "lang") -> DataFrame:
    """key, body: the lines of each page that are its main body, as outside_lines judges them; texts without anything are left out."""
    pages = pages_of(df, key, text, url, lang)
    wrapper = induce(pages)
    return map_pages(wrapper.pages, wrapper, body_rows, f"key {dict(pages.dtypes)['key']}, body string").withColumnRenamed("key", key)


def body_rows(judge: Pages, batch: pa.RecordBatch, constants: list[set[int]]) -> Iterator[pa.RecordBatch]:
    bodies = []
    for page, outside, _ in judge.judged(batch, constants):
        drop = set(outside)
        bodies.append("\n".join(x for n, x in enumerate(page.text, 1) if n not in drop))
    yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(bodies, pa.string())], ["key", "body"])
