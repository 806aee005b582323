"""Which models a text introduces: sentences as tokens, and a small grammar of the ways to introduce a name.

A sentence is a list of words, quoted phrases and marks. Each form of introduction is a function that
looks at the tokens left of a place where a name may begin; the name is then read from there up to a
stopper. No list of names is used.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple
from urllib.parse import unquote, urlsplit

from .names import fold_name, looks_distinctive, looks_title_family

# The words of the grammar.
VERBS = frozenset(
    "introduce introduces introduced present presents presented propose proposes proposed develop develops developed describe describes described report reports reported "
    "release releases released design designs designed create creates created build builds built".split()
)
WORKS = frozenset("paper work study article".split())
THINGS = frozenset("model network architecture system framework method approach operator surrogate learner".split())
CALLED = frozenset("called named dubbed termed".split())
STOPPERS = frozenset("is was are were for that which to with as".split())
FAMILIES = frozenset("model models network networks operator operators architecture architectures".split())
RELATING = frozenset("for to in with from by on".split())
DOING = frozenset("predict predicts enable enables improve improves generate generates learn learns model models".split())
NEURAL_NOUNS = frozenset(f"{w}{s}" for w in "network model architecture operator field surrogate representation encoder decoder learner potential state".split() for s in ("", "s"))
GENERATIVE = frozenset((("generative", "adversarial"), ("generative", "diffusion"), ("denoising", "diffusion"), ("score", "based")))
# Confidences of the forms, for a quoted and a plain name, in the order in which they count.
CONFIDENCE = {"verb": (0.80, 0.78), "called": (0.82, 0.80), "later": (0.78, 0.76), "we call": (0.80, 0.78), "our": (0.78, 0.76), "being": (0.74, 0.72)}
TITLE_QUOTED, TITLE_PREFIX, TITLE_FAMILY, TITLE_VERB, HEADING = 0.68, 0.66, 0.64, 0.64, 0.70
# Kinds of records that are read as a whole, and those whose first heading may name a model.
WHOLE_KINDS = frozenset(("code_repository", "model_card", "provider_page", "catalog_record", "weights"))
HEADED_KINDS = frozenset(("code_repository", "model_card"))
EXTRACTOR = "introduction-cues-v4"
MOST_WORDS, REACH = 10, 220

_TOKEN = re.compile(r"(?P<quoted>[\"'‘“]\w[\w.+\-]*(?:[ \t]+\w[\w.+\-]*)*[\"'’”])|(?P<word>\w(?:[\w+\-]|\.(?=\w))*)|(?P<mark>\S)")
_SENTENCE = re.compile(r"[^.!?\n]*(?:[.!?](?!\s|$)[^.!?\n]*)*(?:[.!?]+|\n|$)")


class Token(NamedTuple):
    text: str
    low: str
    start: int
    end: int
    kind: str


class Cue(NamedTuple):
    name: str
    field: str
    start: int
    end: int
    confidence: float
    quoted: bool = False
    strong: bool = True


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of each sentence; a mark ends one only if white space or nothing follows."""
    return [m.span() for m in _SENTENCE.finditer(text) if m.end() > m.start()]


def tokens(text: str, start: int = 0, end: int | None = None) -> list[Token]:
    found = []
    for m in _TOKEN.finditer(text, start, len(text) if end is None else end):
        kind = m.lastgroup
        found.append(Token(m[0], m[0].lower(), *m.span(), kind))
    return found


def read_name(row: list[Token], at: int) -> tuple[int, int, bool, int] | None:
    """(start, end, quoted, next token) of the name that begins at a token and is followed by a stopper; None if none does."""
    if at >= len(row):
        return None
    head = row[at]
    after = at
    if head.kind == "quoted":
        after = at + 1
    else:
        if head.kind != "word" or not (head.text[0].isdigit() or "A" <= head.text[0] <= "Z"):
            return None
        while after < len(row) and row[after].kind == "word" and row[after].low not in STOPPERS:
            after += 1
            if after - at > MOST_WORDS:
                return None
    if after < len(row) and not (row[after].low in STOPPERS or row[after].text in ",;:()[]–—.!?"):
        return None
    return (head.start + 1, head.end - 1, True, after) if head.kind == "quoted" else (head.start, row[after - 1].end, False, after)


def _back(row: list[Token], at: int, words: frozenset[str] | tuple[str, ...]) -> int:
    """The place before at if the token there is one of words, else at."""
    return at - 1 if at > 0 and row[at - 1].low in words else at


def _said(row: list[Token], at: int) -> bool:
    """Whether the token before at is a verb of introduction whose subject is the author or the work."""
    if at < 2 or row[at - 1].low not in VERBS:
        return False
    return row[at - 2].low == "we" or at >= 3 and row[at - 2].low in WORKS and row[at - 3].low == "this"


def _thing_before(row: list[Token], at: int) -> int:
    """Where a noun phrase like 'deep neural model' that ends before at begins; at if there is none."""
    begin = _back(row, at, THINGS)
    if begin == at:
        return at
    while begin > 0 and (row[begin - 1].low in THINGS or row[begin - 1].low in ("deep", "neural", "-")):
        begin -= 1
    return begin


def _by_verb(row: list[Token], at: int) -> bool:
    return _said(row, at)


def _by_called(row: list[Token], at: int) -> bool:
    """… model, which we called NAME"""
    place = _back(row, at, CALLED)
    if place == at:
        return False
    place = _back(row, _back(row, _back(row, _back(row, place, ("is", "was")), ("we",)), ("which", "that")), (",",))
    return place > 0 and row[place - 1].low in THINGS


def _by_later(row: list[Token], at: int) -> bool:
    """we propose a simple architecture, the NAME"""
    place = _back(row, at, CALLED | {"the"})
    if place < 1 or row[place - 1].text != ",":
        return False
    return any(_said(row, n) and 0 < row[place - 1].start - row[n - 1].end <= REACH for n in range(2, place - 1))


def _by_we_call(row: list[Token], at: int) -> bool:
    """we call our neural model NAME, we refer to it as NAME"""
    place = _back(row, at, ("as",))
    thing = _thing_before(row, place)
    if thing == place:
        return False
    thing = _back(row, thing, ("our", "the", "this"))
    if thing >= 2 and row[thing - 1].low in ("call", "name"):
        return row[thing - 2].low == "we"
    return thing >= 3 and (row[thing - 3].low, row[thing - 2].low, row[thing - 1].low) == ("we", "refer", "to")


def _by_our(row: list[Token], at: int) -> bool:
    """our deep model, NAME,"""
    if at < 1 or row[at - 1].text != ",":
        return False
    thing = _thing_before(row, at - 1)
    return thing < at - 1 and thing > 0 and row[thing - 1].low in ("our", "the", "this")


def _followed(row: list[Token], after: int) -> bool:
    return after < len(row) and row[after].text in ",–—"


def _being(row: list[Token], after: int) -> bool:
    """NAME, a network for …,"""
    if not (_followed(row, after) and after + 1 < len(row) and row[after + 1].low in ("a", "an", "the")):
        return False
    return any(t.text in ",–—" and t.start - row[after + 1].end <= REACH for t in row[after + 3 :])


#: form, what stands before the name, what stands behind it, whether the name must look like one by itself
FORMS: tuple[tuple[str, Callable[[list[Token], int], bool], Callable[[list[Token], int], bool] | None, bool], ...] = (
    ("verb", _by_verb, None, False), ("called", _by_called, None, False), ("later", _by_later, None, False), ("we call", _by_we_call, None, False), ("our", _by_our, _followed, False),
    ("being", lambda row, at: at == 0, _being, True),
)


def _in_body(text: str) -> list[Cue]:
    """The cues of all sentences, the forms in their order, each in the order of the text."""
    found: list[tuple[int, Cue]] = []
    for start, end in sentences(text):
        row = tokens(text, start, end)
        for at, token in enumerate(row):
            if token.kind == "mark":
                continue
            name = None
            for rank, (form, before, behind, strong) in enumerate(FORMS):
                if not before(row, at):
                    continue
                name = name or read_name(row, at)
                if name and (behind is None or behind(row, name[3])):
                    a, b, quoted, _ = name
                    found.append((rank, Cue(text[a:b], "text", a, b, CONFIDENCE[form][0 if quoted else 1], quoted, strong)))
    return [cue for _, cue in sorted(found, key=lambda x: (x[0], not x[1].quoted, x[1].start))]


def _in_title(title: str) -> Iterator[Cue]:
    row = tokens(title)
    head = title[: title.find(": ")] if ": " in title else ""
    if len(row) > 1 and row[0].kind == "quoted" and row[1].text == ":" and head:
        yield Cue(title[row[0].start + 1 : row[0].end - 1], "title", row[0].start + 1, row[0].end - 1, TITLE_QUOTED, quoted=True)
    elif 2 <= len(head.strip()) <= 140:
        start = len(head) - len(head.lstrip())
        yield Cue(head.strip(), "title", start, len(head.rstrip()), TITLE_PREFIX)
    words = [t.kind == "word" for t in row]
    if not row or not words[0] or not row[0].text[0].isupper():
        return
    for n in range(1, min(len(row), MOST_WORDS)):
        if not words[n]:
            break
        ends = n + 1 == len(row) or row[n + 1].low in RELATING
        if row[n].low in FAMILIES and ends and looks_title_family(title[row[0].start : row[n].end]):
            yield Cue(title[row[0].start : row[n].end], "title", row[0].start, row[n].end, TITLE_FAMILY)
            break
    number = len(row) > 1 and bool(re.fullmatch(r"\d+(?:\.\d+)?", row[1].text))
    verb = row[1 + number].low if len(row) > 1 + number else ""
    if verb in DOING and any(c.isupper() for c in row[0].text[1:]):
        yield Cue(title[row[0].start : row[number].end], "title", row[0].start, row[number].end, TITLE_VERB)


def _heading(text: str) -> Iterator[Cue]:
    """The first heading of the first level, if it is plain words."""
    at = 0
    for line in text.split("\n"):
        bare = line.strip()
        if bare.startswith("# ") and len(line) - len(line.lstrip()) <= 3:
            name = bare[2:].strip().rstrip("#").rstrip()
            if re.fullmatch(r"[\w.+\- \t]+", name) and name[0].isalnum() and len(name.split()) <= MOST_WORDS:
                start = at + line.index(name)
                yield Cue(name, "text", start, start + len(name), HEADING)
                return
        at += len(line) + 1


def neural(context: str) -> bool:
    """Whether the words speak of a neural model."""
    words = re.findall(r"[a-z]+|[^\sa-z\-]", context.lower())
    pairs = set(zip(words, words[1:]))
    if any(a == "deep" and b in ("learning", "neural") or a == "neural" and b in NEURAL_NOUNS for a, b in pairs):
        return True
    if any((a, b) in GENERATIVE and c in ("network", "networks", "model", "models") for a, b, c in zip(words, words[1:], words[2:])):
        return True
    attends = any(a == "attention" and (b.startswith("mechanism") or b == "based" and c.startswith("mechanism")) for a, b, c in zip(words, words[1:], [*words[2:], ""]))
    return attends and ("network", "architecture") in pairs


def _linked(name: str, links: list[tuple[str, str]]) -> bool:
    """Whether a card or weights of that name are linked."""
    wanted = fold_name(name).replace(" ", "")
    paths = (unquote(urlsplit(url).path) for url, relation in links if relation in ("model_card", "weights"))
    return any(wanted and fold_name(part.replace("_", " ")).replace(" ", "") == wanted for path in paths for part in path.split("/"))


def _in_scope(cue: Cue, title: str, text: str, kind: str, links: list[tuple[str, str]]) -> bool:
    if cue.field == "title" and _linked(cue.name, links):
        return True
    if kind in WHOLE_KINDS:
        return neural(f"{title}\n{text}")
    spans = sentences(text)
    if cue.field == "title":
        first = text[slice(*spans[0])] if spans else ""
        return neural(f"{title}\n{first}")
    at = next(n for n, (_, end) in enumerate(spans) if cue.start < end)
    if neural(text[slice(*spans[at])]):
        return True
    # A neighbouring sentence counts if it repeats the name.
    again = re.compile(rf"(?<!\w){r'\s+'.join(map(re.escape, cue.name.split()))}(?!\w)", re.I)
    beside = [text[slice(*spans[n])] for n in (at - 1, at + 1) if 0 <= n < len(spans)]
    return any(again.search(s) and neural(s) for s in beside)


def introduced(title: str, text: str, kind: str, links: list[tuple[str, str]] = ()) -> list[tuple[str, str, float, str]]:
    """(name, normalized name, confidence, locator) of the models that a record introduces; the first form of a name counts."""
    cues = [*_in_title(title), *(_heading(text) if kind in HEADED_KINDS else ()), *_in_body(text)]
    out: dict[str, tuple[str, str, float, str]] = {}
    for cue in cues:
        folded = fold_name(cue.name)
        if folded and folded not in out and looks_distinctive(cue.name, cue.quoted, cue.strong) and _in_scope(cue, title, text, kind, links):
            out[folded] = (cue.name, folded, cue.confidence, f"{cue.field}:{cue.start}:{cue.end}")
    return list(out.values())
