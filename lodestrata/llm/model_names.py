"""Names of models taken apart: core, version, size and tuning, as meant rather than as spelled."""

from __future__ import annotations

import re
import unicodedata
from typing import NamedTuple

# The words by which sources name one tuning.
TUNINGS = {
    "base": "base foundation pretrained pretrain pt",
    "code": "code coder coding programming",
    "vision": "vision visual vl multimodal",
    "chat": "chat conv conversational dialog dialogue",
    "instruct": "instruct instruction instructed instr inst it",
}
# Letters of other scripts that look like Latin ones.
LOOKALIKES = str.maketrans("аеорсухіјѕԁһӏӓёвкмнтαεοριυνκχ", "aeopcyxijsdhlaebkmhtaeopiuvkx")
_WORD_TUNING = {word: tuning for tuning, words in TUNINGS.items() for word in words.split()}
_TUNING_WORDS = "|".join(sorted(_WORD_TUNING, key=len, reverse=True))
_UNIT = {"b": 1e9, "bn": 1e9, "billion": 1e9, "m": 1e6, "mn": 1e6, "million": 1e6}
_SIZE = re.compile(rf"(?<![\d.])(\d+(?:\.\d+)?) ?(billion|million|bn|mn|b|m)(?: ?param(?:eter)?s?|(?=$|[ )]|{_TUNING_WORDS}))")
_PLAIN_SIZE = re.compile(r"^\d+(?:\.\d+)?(?:e\+?\d+)?$")
_MARKED_VERSION = re.compile(r"(?:version|\bver|v)[ .]?(\d)(?:([. ])(\d))?(?!\d*e)")
_GLUED_VERSION = re.compile(r"(?<=[a-z])(\d)(?:\.(\d))?(?=\d)")
_ROMAN = {"ii": "2", "iii": "3", "iv": "4"}
_INVISIBLE = re.compile("[­​-‏⁠﻿]")


class Name(NamedTuple):
    core: str
    version: str  #: '' if the name has none
    size: int | None
    tuning: str  #: '' if the name has none
    bare: bool  #: the core alone, which says nothing about version and tuning


def plain(text: str) -> str:
    """Lower Latin letters without accents, look-alikes and invisible characters."""
    text = unicodedata.normalize("NFKC", _INVISIBLE.sub("", text)).casefold().translate(LOOKALIKES)
    return "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c))


def read_size(label: str | None) -> int | None:
    """Parameters meant by a size of its own: 7B, 7 billion, 7e9, 7000M, 7000000000."""
    if not label:
        return None
    text = plain(label).replace(",", "").strip()
    if _PLAIN_SIZE.match(text):
        number = float(text)
        return round(number) if 1e5 <= number < 1e15 else None
    found = _SIZE.search(text)
    return round(float(found[1]) * _UNIT[found[2]]) if found else None


def _rest(text: str) -> tuple[int | None, str]:
    found = _SIZE.search(text)
    if not found:
        return None, text
    return round(float(found[1]) * _UNIT[found[2]]), text[: found.start()] + " " + text[found.end() :]


def read_name(text: str, sizes: frozenset[int] = frozenset(), meant: int | None = None) -> Name:
    """The parts of a name in any of the usual orders and joins.

    Where digits run together, the reading wins whose size is the one meant elsewhere, or one of the usual sizes.
    """
    text = plain(text)
    if "/" in text:
        text = text.rsplit("/", 1)[1]
    text = re.sub(r"(?<!\d)\.|\.(?!\d)", " ", re.sub(r"[^a-z0-9.]+", " ", text)).strip()
    text = re.sub(r" (?:params?|parameters)\b", " ", text)
    best: tuple[float, str, int | None, str] | None = None
    options: list[tuple] = [("", text)]
    for m in _MARKED_VERSION.finditer(text):
        before = text[: m.start()]
        options.append((m[1], before + " " + text[m.end(1) :]))
        if m[3]:
            minor = "" if m[3] == "0" else "." + m[3]
            options.append((m[1] + minor, before + " " + text[m.end(3) :]))
    for m in re.finditer(r"(?<![\w.])(\d)(?:\.(\d))?(?= |$)(?! ?(?:billion|million|bn|mn|b|m)\b)", text):
        options.append((m[1] + ("." + m[2] if m[2] and m[2] != "0" else ""), text[: m.start()] + " " + text[m.end() :]))
    for m in _GLUED_VERSION.finditer(text):
        options.append((m[1], text[: m.start()] + " " + text[m.end(1) :], 1.5))
        if m[2]:
            options.append((m[1] + ("" if m[2] == "0" else "." + m[2]), text[: m.start()] + " " + text[m.end() :], 1.5))
    for m in re.finditer(r"\b(ii|iii|iv)\b|(?<=[a-z])(?:(?<!i)i{2,3})(?= ?\d)", text):
        options.append((_ROMAN[m[0]], text[: m.start()] + " " + text[m.end() :]))
    for version, left, *doubt in options:
        if re.match(r"\.\d", left[len(left.rstrip()) - len(left.lstrip()) :].strip()) or " ." in left:
            continue
        size, left = _rest(left)
        score = 2.0 * (size is not None) + 1.0 * bool(version) - sum(doubt) + 2.0 * (size is not None and size in sizes) + 3.0 * (size is not None and size == meant) - 3.0 * bool(re.search(r"\d", left)) - 0.5 * bool(re.search(r"[a-z]v(?:ersion)?(?: |$)", left) and not version)
        if best is None or score > best[0]:
            best = (score, version, size, left)
    _, version, size, left = best
    tuning, words = "", []
    for word in left.split():
        if word in _WORD_TUNING and not tuning:
            tuning = _WORD_TUNING[word]
        else:
            words.append(word)
    core = re.sub(r"[^a-z]", "", "".join(words))
    if not core:  # a name that is nothing but a tuning word
        core, tuning = re.sub(r"[^a-z]", "", left), ""
    return Name(core, version, size, tuning, not version and size is None and not tuning)
