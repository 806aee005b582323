"""Splitting several values packed in one cell (problem 1).

Dictionary-guided segmentation. An Aho-Corasick automaton marks every known whole value in the cell,
quoted stretches and plain stretches between delimiters are the other candidates, and dynamic
programming takes the cheapest cover of the cell. A known value that contains delimiters is one
cheap piece and so survives; the same delimiters between values still split.
"""

from __future__ import annotations

import ast
import json
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What cells say for "nothing", lower case.
NOTHING = frozenset(("", "-", "--", "–", "—", "n/a", "na", "n.a.", "none", "null", "nil", "unknown", "unspecified", "nan", "?", ".", "[]", "tbd", "tba"))
CONJUNCTIONS = frozenset(("and", "und", "et", "y", "&", "+"))
QUOTES = {'"': '"', "'": "'", "“": "”", "„": "“", "«": "»", "‘": "’", "`": "`"}

_SPACE = " \t\r\n\v\f             ​    　﻿"
_DELIMITER = re.compile(rf"[{_SPACE}]*(?:<br\s*/?>|&#10;|[,;|\n\t\r；，、｜·•‧・]|(?<=[{_SPACE}])/(?=[{_SPACE}]))[{_SPACE}]*", re.I)
_AND = re.compile(rf"[{_SPACE}]+(?:and|und|et|y|&|\+)[{_SPACE}]+", re.I)
_LEAD = re.compile(rf"[{_SPACE}]*(?:(?:\(?\d{{1,3}}[.)]|[-*•–])[{_SPACE}]+)?")
_AND_LEAD = re.compile(rf"(?:and|und|&)[{_SPACE}]+", re.I)
_NUMBERED = re.compile(rf"(?:^|(?<=[{_SPACE}]))\(?(\d{{1,3}})[.)][{_SPACE}]+")
_LINK = re.compile(r"(?:https?|ftp)://", re.I)
_LINK_EDGE = _SPACE + ",;|<>\"'“”‘’«»[]()`"
#: Costs of the cover: a known or quoted value, a plain stretch, a conjunction taken as a delimiter, one left inside a plain stretch.
#: So a conjunction splits where a value beside it is known.
KNOWN_COST, PLAIN_COST, AND_COST, INNER_COST = 1.0, 6.0, 2.5, 4.0


def fold(text: str) -> str:
    """Lower case that keeps every character's place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


class Segmenter:
    """Splits cells of one field by its known values."""

    def __init__(self, known: Sequence[str], links: bool = False):
        import ahocorasick

        self.known = {fold(k.strip()): len(k.strip()) for k in known if k and k.strip()}
        self.links = links
        self.automaton = ahocorasick.Automaton()
        for value, length in self.known.items():
            self.automaton.add_word(value, length)
        if self.known:
            self.automaton.make_automaton()

    def split(self, cell: str | None) -> list[str]:
        if cell is None:
            return []
        text = cell.strip(_SPACE)
        if text.lower() in NOTHING:
            return []
        if fold(text) in self.known:
            return [text]
        if text[0] == "[" and text[-1] == "]" and (items := self._literal(text)) is not None:
            return items
        items = self._links(text) if self.links and _LINK.search(text) else self._numbered(text) or self._cover(text)
        return [i for i in items if i.lower() not in NOTHING]

    def _numbered(self, text: str) -> list[str]:
        """The entries of a list numbered from 1, each one value whatever it holds; none if it is no such list."""
        cuts: list[tuple[int, int]] = []
        for m in _NUMBERED.finditer(text):
            if int(m[1]) == len(cuts) + 1 and (cuts or m.start() == 0):
                cuts.append(m.span())
        ends = [a for a, _ in cuts[1:]] + [len(text)]
        return [self._bare(text[b:end]) for (_, b), end in zip(cuts, ends)]

    def _bare(self, piece: str) -> str:
        piece = piece.strip(_SPACE)
        if fold(piece) not in self.known:
            piece = piece.strip(_SPACE + ",;|")
            close = QUOTES.get(piece[:1])
            if close and len(piece) > 1 and self._quoted(piece, 0, close)[0] == len(piece):
                return self._quoted(piece, 0, close)[1]
        return piece

    def _literal(self, text: str) -> list[str] | None:
        for read in (json.loads, ast.literal_eval):
            try:
                found = read(text)
            except (ValueError, SyntaxError, MemoryError, RecursionError):
                continue
            if isinstance(found, list) and all(x is None or isinstance(x, (str, int, float)) for x in found):
                items = ["" if x is None else str(x).strip(_SPACE) for x in found]
                return [i for i in items if i.lower() not in NOTHING]
        return None

    def _links(self, text: str) -> list[str]:
        """A link starts where a scheme follows a delimiter; a scheme right behind other characters is inside a link."""
        starts = [m.start() for m in _LINK.finditer(text) if m.start() == 0 or text[m.start() - 1] in _LINK_EDGE]
        items = []
        for a, b in zip([0, *starts], [*starts, len(text)]):
            piece = text[a:b].strip(_LINK_EDGE)
            # What stands beside links is split as plain text.
            if _LINK.match(piece):
                head, *rest = re.split(rf"[{_SPACE}<>\"“”]+", piece, maxsplit=1)
                items += [head.rstrip(_LINK_EDGE), *(self._cover(rest[0]) if rest and rest[0].strip(_LINK_EDGE) else [])]
            elif piece:
                items += [x for x in self._cover(piece) if not re.fullmatch(r"\d{1,3}[.)]|[-*•]", x)]
        return [i for i in items if i.lower() not in CONJUNCTIONS]

    def _cover(self, text: str) -> list[str]:
        size = len(text)
        gaps = [m.span() for m in _DELIMITER.finditer(text)]
        ends = {a: b for a, b in gaps}
        ands = {m.start(): m.end() for m in _AND.finditer(text)}
        known: dict[int, list[int]] = {}
        if self.known:
            for last, length in self.automaton.iter(fold(text)):
                known.setdefault(last + 1 - length, []).append(last + 1)

        def after(end: int) -> tuple[int, float] | None:
            """Where the next item can start if one ends here, and what the delimiter costs."""
            stop = end
            while stop < size and text[stop] in _SPACE and stop not in ends and stop not in ands:
                stop += 1
            for at in (end, stop):
                if at in ends:
                    return ends[at], 0.0
                if at in ands:
                    return ands[at], AND_COST
            return (size, 0.0) if stop == size else None

        best: dict[int, tuple[float, int, str | None]] = {0: (0.0, -1, None)}
        order = [0]
        seen = {0}
        at = 0
        while at < len(order):
            order[at:] = sorted(order[at:])
            start = order[at]
            at += 1
            if start >= size:
                continue
            cost = best[start][0]

            def reach(to: int, more: float, item: str | None, start: int = start, cost: float = cost) -> None:
                if to not in best or cost + more < best[to][0]:
                    best[to] = (cost + more, start, item)
                    if to not in seen:
                        seen.add(to)
                        order.append(to)

            if start in ends:  # an empty place
                reach(ends[start], 0.0, None)
                continue
            begin = _LEAD.match(text, start).end()
            if start and (m := _AND_LEAD.match(text, begin)):
                if text[m.end() :].strip(_SPACE):
                    begin = m.end()
            if begin >= size:
                reach(size, 0.0, None)
                continue
            for b in {start, begin}:
                for end in known.get(b, ()):
                    if (nxt := after(end)) is not None:
                        reach(nxt[0], KNOWN_COST + nxt[1], text[b:end])
            close = QUOTES.get(text[begin])
            if close is not None:
                end, item = self._quoted(text, begin, close)
                if end and (nxt := after(end)) is not None:
                    reach(nxt[0], KNOWN_COST + nxt[1], item)
            # A plain stretch runs to the next delimiter that no bracket encloses.
            end, nxt_start = self._plain(text, begin, gaps)
            inner = [(a, b) for a, b in ands.items() if begin < a < end]
            reach(nxt_start, PLAIN_COST + INNER_COST * len(inner), text[begin:end].strip(_SPACE))
            for n, (a, b) in enumerate(inner):
                reach(b, PLAIN_COST + AND_COST + INNER_COST * n, text[begin:a].strip(_SPACE))
        items, to = [], size
        while to > 0:
            _, start, item = best[to]
            if item:
                items.append(item)
            to = start
        return items[::-1]

    @staticmethod
    def _quoted(text: str, begin: int, close: str) -> tuple[int, str]:
        """End and content of the quoted stretch; a doubled or escaped quote is part of it."""
        at, out = begin + 1, []
        while at < len(text):
            if text[at] == "\\" and text[at + 1 : at + 2] == close:
                out.append(close)
                at += 2
            elif text[at] == close and text[at + 1 : at + 2] == close and at + 2 < len(text):
                out.append(close)
                at += 2
            elif text[at] == close:
                return at + 1, "".join(out).strip(_SPACE)
            else:
                out.append(text[at])
                at += 1
        return 0, ""

    @staticmethod
    def _plain(text: str, begin: int, gaps: list[tuple[int, int]]) -> tuple[int, int]:
        depth, last = 0, begin
        for a, b in gaps:
            if a < begin:
                continue
            depth += text.count("(", last, a) - text.count(")", last, a)
            last = a
            if depth <= 0 or ")" not in text[a:]:
                return a, b
        return len(text), len(text)


def frequent_values(cells: DataFrame, share: float) -> DataFrame:
    """field, item of the cells that are one plain value and make up at least share of their field's cells.

    They extend the known values. A field has at most 1 / share of them, however large the table.
    """
    plain = F.trim("cell")
    mixed = F.lower(plain).rlike(r"[,;|/\n\t\r\u00a0；，、｜·•‧・\"“”„«»\[\]()<>]| (and|und|et|y|&|\+) |^['‘`-]|^\d{1,3}[.)]") | F.lower(plain).isin(*sorted(NOTHING))
    values = cells.where(~mixed & (F.length(plain) > 0)).groupBy("field", plain.alias("item")).agg(F.count("*").alias("n"))
    totals = cells.groupBy("field").agg(F.count("*").alias("cells"))
    return values.join(totals, "field").where((F.col("n") >= 2) & (F.col("n") >= F.col("cells") * share)).select("field", "item")


def split_packed(
    df: DataFrame, key: str, fields: Sequence[str], known: DataFrame, link_fields: Sequence[str] = (), share: float = 0.001, max_known: int = 100_000
) -> DataFrame:
    """key, field, pos, item: each value of each cell of fields, in the order written from 1.

    known has field and item, the known whole values; the frequent plain values of df's own cells
    (see frequent_values) join them. They go to every task, so known may have max_known rows at most;
    more is an error. Known values match without regard to case and come out as written. Null cells,
    cells that say "nothing" and empty places give no row, repeated values one each. Quotes, brackets,
    bullets and numbers that only list a value are taken off. Rows with a null key keep it. Cells of
    any length are split whole. Other columns of df, whatever their names, are ignored.
    """
    rows = known.select("field", "item").where("field is not null and item is not null").limit(max_known + 1).collect()
    if len(rows) > max_known:
        raise ValueError(f"more than {max_known} known values")
    cells = df.select(
        F.col(key).alias("key"), F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("cell")) for f in fields])).alias("x")
    ).select("key", "x.field", "x.cell").where(F.col("cell").isNotNull())
    words: dict[str, list[str]] = {f: [] for f in fields}
    for field, item in [*rows, *frequent_values(cells.where(~F.col("field").isin(*link_fields)) if link_fields else cells, share).collect()]:
        words.setdefault(field, []).append(item)
    kind = dict(cells.dtypes)["key"]
    linked = frozenset(link_fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = {f: Segmenter(w, f in linked) for f, w in words.items()}
        for batch in batches:
            names, texts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            take, places, items = [], [], []
            for row, (name, text) in enumerate(zip(names, texts)):
                for pos, item in enumerate(tools[name].split(text), 1):
                    take.append(row)
                    places.append(pos)
                    items.append(item)
            index = pa.array(take, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(index), batch.column(1).take(index), pa.array(places, pa.int32()), pa.array(items, pa.string())], ["key", "field", "pos", "item"]
            )

    return cells.mapInArrow(run, f"key {kind}, field string, pos int, item string").withColumnRenamed("key", key)
