"""The lines of a batch of pages as numbers: one pass of Arrow kernels over all distinct lines of the batch.

A line has two nodes, its label (numbers, list marks and the site's name masked) and its wording (names
masked, too), and one more for each of its segments if it lists several things. Nodes are 63-bit
hashes: even ones are labels, odd ones wordings. Lines of any length are treated alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MARK = re.compile(r"^(?:(?:[*•·›»>\-–—]+|\(?\d{1,3}[.)])\s+)+")
_NUMBER = re.compile(r"\d+(?:[.,]\d+)*")
_PARTS = re.compile(r"\s+[·|•]\s+|[\s ]{3,}|\s+[>»›/]\s+")
_NAMES = re.compile(r"[^\W\d_a-zß-öø-ÿ][^\W_]*(?:[-#@][^\W_]*)*(?: [^\W\d_a-zß-öø-ÿ][^\W_]*(?:[-#@][^\W_]*)*)*")
_SITE = re.compile(r"([^.]+)\.[^.]+$")
# The same for Arrow's kernels, whose classes are ASCII only unless they are named.
_SPACE = r"\t\n\f\r \x0b\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_ARROW_MARK = rf"^(?:(?:[*•·›»>\-–—]+|\(?\p{{Nd}}{{1,3}}[.)])[{_SPACE}]+)+"
_ARROW_NUMBER = r"\p{Nd}+(?:[.,]\p{Nd}+)*"
_ARROW_GAP = rf"[{_SPACE}]+"
_ARROW_ODD_GAP = rf"  |[\t\n\f\r\x0b\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]"
_WORD = r"[\p{L}\p{N}]"
_NAME = rf"[\p{{Lu}}\p{{Lt}}\p{{Lo}}\p{{Lm}}]{_WORD}*(?:[-#@]{_WORD}*)*"
_ARROW_NAMES = rf"{_NAME}(?: {_NAME})*"
_ARROW_SEPARATED = rf"[{_SPACE}][·|•>»›/][{_SPACE}]|[{_SPACE}]{{3}}"
CHUNK = 20_000_000  #: bytes of text that one pass takes; a longer text is a pass of its own


def site_word(host: str) -> str:
    """The word of a host that names its site."""
    m = _SITE.search(host)
    return m[1].lower() if m else ""


def label(line: str, site: str) -> str:
    """What a line keeps on every page: without its list mark, with numbers and the site's name masked."""
    text = MARK.sub("", line.strip())
    text = text.replace("[", "").replace("]", "")
    text = _NUMBER.sub("#", text)
    if site and len(site) > 2 and site in text.lower():
        text = re.sub(re.escape(site), "@", text, flags=re.I)
    return " ".join(text.split())


def wording(labelled: str) -> str:
    """A label without names."""
    return _NAMES.sub("C", labelled)


def parts(line: str) -> list[str]:
    found = _PARTS.split(line.strip())
    return found if len(found) > 2 else []


def labels(lines: pa.Array) -> pa.Array:
    """label of many lines of pages that do not name their site."""
    text = pc.replace_substring_regex(lines, _ARROW_MARK, "")
    text = _where(text, pc.match_substring_regex(text, r"[\[\]]"), lambda x: pc.replace_substring_regex(x, r"[\[\]]", ""))
    text = pc.replace_substring_regex(text, _ARROW_NUMBER, "#")
    text = _where(text, pc.match_substring_regex(text, _ARROW_ODD_GAP), lambda x: pc.replace_substring_regex(x, _ARROW_GAP, " "))
    return pc.utf8_trim(text, " ")


def _where(text: pa.Array, mask: pa.Array, change) -> pa.Array:
    return pc.replace_with_mask(text, mask, change(text.filter(mask))) if pc.any(mask).as_py() else text


_random = np.random.default_rng(77)
_BYTES = _random.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(int(_random.integers(1, 2**59)) * 8 + 5)  # 5 modulo 8: its powers repeat only after 2**62 bytes
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: list[np.ndarray] = []


def _powers_to(count: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, kept for the next call."""
    if not _powers or len(_powers[0]) < count:
        with np.errstate(over="ignore"):
            _powers[:] = [np.cumprod(np.r_[np.uint64(1), np.full(max(count, 1 << 20) - 1, base, np.uint64)], dtype=np.uint64) for base in (_BASE, _UNBASE)]
    return _powers


def hashes(strings: pa.Array) -> np.ndarray:
    """A 63-bit number for each string: a polynomial over random numbers of its bytes, mixed. All bytes count."""
    strings = strings.cast(pa.large_string())
    out = np.zeros(len(strings), np.uint64)
    if not len(strings):
        return out.astype(np.int64)
    ends = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset : strings.offset + len(strings) + 1]
    data = np.frombuffer(strings.buffers()[2] or b"", np.uint8)
    start = 0
    while start < len(strings):  # a million bytes at a time, a longer string alone
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + (1 << 20) - 1, side="right")) - 1)
        own = ends[start : stop + 1] - ends[start]
        piece = data[ends[start] : ends[stop]]
        up, down = _powers_to(len(piece) + 1)
        with np.errstate(over="ignore"):
            sums = np.zeros(len(piece) + 1, np.uint64)
            np.cumsum(_BYTES[piece] * up[: len(piece)], out=sums[1:])
            out[start:stop] = (sums[own[1:]] - sums[own[:-1]]) * down[own[:-1]] + np.diff(own).astype(np.uint64)
        start = stop
    with np.errstate(over="ignore"):
        for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            out = (out ^ (out >> np.uint64(shift))) * np.uint64(times)
    return ((out ^ (out >> np.uint64(31))) >> np.uint64(1)).astype(np.int64)


class Lines(NamedTuple):
    """The lines of one page, each with its two nodes (0 for a blank line), and the segments' nodes by line."""

    text: list[str]
    label: list[int]
    wording: list[int]
    parts: dict[int, list[int]]

    def nodes(self) -> list[int]:
        """The distinct nodes in document order."""
        out: list[int] = []
        done = 0
        pairs = [n for pair in zip(self.label, self.wording) for n in pair if n]
        if not self.parts:
            return list(dict.fromkeys(pairs))
        full = [i for i, n in enumerate(self.label) if n]
        for at, line in enumerate(full):
            if line in self.parts:
                out += pairs[2 * done : 2 * at + 2] + self.parts[line]
                done = at + 1
        return list(dict.fromkeys(out + pairs[2 * done :]))


class Read(NamedTuple):
    """The lines of many pages, one page behind the other: page p has those from bounds[p] to bounds[p + 1], line i is distinct[at[i]] but for blanks around it."""

    lines: pa.Array
    bounds: np.ndarray
    distinct: pa.Array
    at: np.ndarray
    label: np.ndarray
    wording: np.ndarray
    parts: dict[int, dict[int, list[int]]]  #: by page and line


class LineReader:
    """Reads pages; what is dear is done once for each distinct line and remembered only within a pass."""

    def pages(self, hosts: list[str], texts: pa.Array) -> Iterator[Lines]:
        """The lines of each text; none of texts is null."""
        for read in self.read(hosts, texts):
            lines, label, wording, bounds = read.lines.to_pylist(), read.label.tolist(), read.wording.tolist(), read.bounds.tolist()
            for page, (a, b) in enumerate(zip(bounds, bounds[1:])):
                yield Lines(lines[a:b], label[a:b], wording[a:b], read.parts.get(page, {}))

    def read(self, hosts: list[str], texts: pa.Array) -> Iterator[Read]:
        """The same as arrays, a pass at a time."""
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        start = 0
        while start < len(texts):
            taken = np.cumsum(sizes[start:])
            count = max(1, int(np.searchsorted(taken, CHUNK, side="right")))
            yield self._pass(hosts[start : start + count], texts.slice(start, count))
            start += count

    def _pass(self, hosts: list[str], texts: pa.Array) -> Read:
        split = pc.split_pattern(texts.cast(pa.large_string()), "\n")
        bounds = np.r_[0, np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))].tolist()
        flat = split.flatten()
        coded = pc.utf8_trim_whitespace(flat).dictionary_encode()
        at, distinct = coded.indices.to_numpy(), coded.dictionary
        plain = labels(distinct)
        label_of, wording_of = hashes(plain) & ~1, hashes(pc.replace_substring_regex(plain, _ARROW_NAMES, "C")) | 1
        blank = pc.equal(distinct, "").to_numpy(zero_copy_only=False)
        label_of[blank] = wording_of[blank] = 0
        every_label, every_wording = label_of[at], wording_of[at]
        # Lines that name their site, and segments, are read line by line.
        separated = pc.match_substring_regex(distinct, _ARROW_SEPARATED).to_numpy(zero_copy_only=False)
        named, listed = [], []
        for page, (host, text) in enumerate(zip(hosts, texts.to_pylist())):
            site = site_word(host)
            low = text.lower() if len(site) > 2 else ""
            if low and site in low:
                first = bounds[page]
                named += [(first + i, site, line.strip()) for i, line in enumerate(low.split("\n")) if site in line]
        flat_at = {}
        if named:
            keys = list(dict.fromkeys((site, int(at[i])) for i, site, _ in named))
            read = [label(distinct[u].as_py(), site) for site, u in keys]
            own = hashes(pa.array(read, pa.string())) & ~1
            worded = hashes(pa.array([wording(x) for x in read], pa.string())) | 1
            flat_at = {k: n for n, k in enumerate(keys)}
            place = [i for i, _, _ in named]
            turn = [flat_at[site, int(at[i])] for i, site, _ in named]
            every_label, every_wording = every_label.copy(), every_wording.copy()
            every_label[place], every_wording[place] = own[turn], worded[turn]
        segments: dict[tuple[str, int], list[int]] = {}
        rows = np.flatnonzero(separated[at])
        owner = np.searchsorted(bounds, rows, side="right") - 1
        strings: list[str] = []
        spans: dict[tuple[str, int], tuple[int, int]] = {}
        for row, page in zip(rows.tolist(), owner.tolist()):
            key = (site_word(hosts[page]), int(at[row]))
            if key not in spans:
                found = [label(p, key[0]) for p in parts(distinct[key[1]].as_py())]
                spans[key] = (len(strings), len(strings) + len(found))
                strings += found
            listed.append((page, row - bounds[page], key))
        numbers = (hashes(pa.array(strings, pa.string())) & ~1).tolist()
        segments = {k: numbers[a:b] for k, (a, b) in spans.items()}
        by_page: dict[int, dict[int, list[int]]] = {}
        for page, line, key in listed:
            if segments[key]:
                by_page.setdefault(page, {})[line] = segments[key]
        return Read(flat, np.array(bounds), distinct, at, every_label, every_wording, by_page)
