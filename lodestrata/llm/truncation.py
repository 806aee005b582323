"""Texts cut off by field limits or in transfer (problem 10).

Near-copies come first: bodies that share a band of their min-hash signature, or of that of an
opening, are paired with every longer one of the band, verified on their five-word shingles (0.8 of
the short text's are in the longer one) and aligned; a copy whose end lies inside a longer one was cut. A record without such a copy is judged by its end: does its source pile up
texts of exactly one length, does it end in a cut character or a mark of omission, and does its last
line close as complete lines do - a sentence by its mark, any other line by a wording and a closing
word that complete lines of the corpus have.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.skew import lookup_join
from ..session import cut_lineage
from .boilerplate import Pages, Wrapper, _hash, body_rows, induce, map_pages, pages_of
from .line_nodes import hashes

WORDS, BANDS, ROWS, SIMILAR = 5, 10, 4, 0.8
OPENING = 8  #: shingles of the shortest opening; the others are twice as long each
# Marks that stand for what was cut off, that end a sentence, and that may follow such a mark.
CUT_SIGNS = ("…", "\ufffd")
OMITTED = re.compile(r"\[\s*(?:more|\.\.\.|…|truncated|cut|continued|mehr|suite|más)\s*\]|\((?:more|continued|truncated)\)", re.I)
SENTENCE_ENDS, CLOSERS = ".!?。！？", "'\"”’»)]"
MARKS = frozenset(" \t*•·›»>-–—#$(0123456789")
_DOTTED = re.compile(r"(\w+)\.\.\.(?:$| )")
_LINK = re.compile(r"^(?:https?|ftp)://\S+$")


_LOWER, _UPPER = "a-zàáâãäåæçèéêëìíîïñòóôõöøùúûüýÿßœ", "A-ZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝŒ"
_MIXED = r"[Cx#]*(?:[Cx]#|#[Cx])[Cx#]*"
_SAME = re.compile(r"(?:(?<= )|^)([Cx#]+)(?: \1)+(?= |$)")


def forms(lines: list[str]) -> list[str]:
    """How lines of any length are built: list mark, signs, and runs of words and numbers by the kinds of their characters.

    Who or what stands behind a comma takes many forms, so it is left out.
    """
    text = pc.utf8_trim_whitespace(pa.array(lines, pa.large_string()))
    bare = pc.replace_substring_regex(text, r"^(?:[*•·›»>\-–—]+|\(?[0-9]{1,3}[.)])\s+", "")
    listed = pc.less(pc.binary_length(bare), pc.binary_length(text)).to_pylist()
    bare = pc.replace_substring_regex(bare, r"(?s), .*$", ", …")
    for found, kind in ((f"[{_LOWER}]+", "x"), (f"[{_UPPER}]+", "C"), ("[0-9#]+", "#"), (_MIXED, "w")):
        bare = pc.replace_substring_regex(bare, found, kind)
    return [("* " if mark else "") + (_SAME.sub(r"\1", x) if " " in x else x) for mark, x in zip(listed, bare.to_pylist())]


def closing(line: str) -> str:
    """The last word of a line in the form in which it can recur: a lower word itself, of a capital one the last two letters, # for a number, else the last sign."""
    token = line.rstrip().rpartition(" ")[2]
    at = 0 if token.isalnum() else len(token)
    while at and token[at - 1].isalnum():
        at -= 1
    word = token[at:].lstrip("0123456789")
    if word:
        return "~" + word[-2:] if word[0].isupper() else word
    at = len(token)
    while at and token[at - 1] in "0123456789.,":
        at -= 1
    number = token[at:].lstrip(".,")
    return ("#" if number[-1].isdigit() else "#" + number[-1]) if number else token[-1:]


def omitted(text: str) -> bool:
    """Whether a text without blanks at its end closes with a mark that stands for what was cut off."""
    if text.endswith(CUT_SIGNS):
        return True
    at = text.rfind({"]": "[", ")": "("}.get(text[-1:], "\0"))
    return at >= 0 and bool(OMITTED.fullmatch(text, at))


def ends_sentence(line: str) -> bool:
    return line.rstrip(CLOSERS)[-1:] in tuple(SENTENCE_ENDS)


def before_dots(line: str) -> str | None:
    """The word in front of the three dots that end a line, '' for none; None if no dots end it."""
    bare = line.rstrip(CLOSERS)
    if not bare.endswith("..."):
        return None
    token = bare[:-3].rstrip().rpartition(" ")[2]
    at = len(token)
    while at and (token[at - 1].isalnum() or token[at - 1] == "_"):
        at -= 1
    return token[at:]


class Signer:
    """Min-hash signatures of five-word shingles, a band in one number; of many texts at once."""

    def __init__(self):
        made = np.random.default_rng(20).integers(1, 2**63, (2, BANDS * ROWS), dtype=np.uint64)
        self.times, self.plus = made[0] | np.uint64(1), made[1]
        self.mix = np.random.default_rng(21).integers(1, 2**63, ROWS, dtype=np.uint64) | np.uint64(1)

    @staticmethod
    def codes(words: list[str]) -> np.ndarray:
        """A number for each word; every distinct word is hashed once."""
        import xxhash

        coded = pa.array(words, pa.string()).dictionary_encode()
        distinct = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
        return distinct[coded.indices.to_numpy()] if len(words) else np.zeros(0, np.uint64)

    @staticmethod
    def roll(codes: np.ndarray) -> np.ndarray:
        """A number for each run of five codes."""
        count = len(codes) - WORDS + 1
        with np.errstate(over="ignore"):
            total = np.zeros(count, np.uint64)
            for i in range(WORDS):
                total = (total ^ codes[i : count + i]) * np.uint64(0x9E3779B97F4A7C15)
                total ^= total >> np.uint64(29)
        return total

    @staticmethod
    def shingles(words: list[str]) -> np.ndarray:
        codes = Signer.codes(words)
        return Signer.roll(np.r_[codes, np.zeros(max(0, WORDS - len(codes)), np.uint64)])

    def bands(self, texts: list[list[str]]) -> tuple[list[list[int]], np.ndarray, np.ndarray]:
        """Bands, stop and tail of each text. Shorter texts than a shingle are filled up.

        Its bands are those of the whole, then those of its openings of 8, 16, ... shingles; none for a text without words.
        stop is its last shingle without the last word, which may be cut, and tail stands for its last six words (0 if it has less).
        """
        if not texts:
            return [], np.zeros(0, np.int64), np.zeros(0, np.int64)
        sizes = np.array([len(w) for w in texts], np.int64)
        padded = np.maximum(sizes, WORDS)
        starts = np.cumsum(padded) - padded
        flat = np.zeros(int(padded.sum()), np.uint64)
        flat[np.repeat(starts, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = self.codes([w for words in texts for w in words])
        counts = padded - WORDS + 1
        grams = self.roll(flat)[np.repeat(starts, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)]
        at = np.cumsum(counts) - counts
        # A text's pieces: up to 8 shingles, to 16, ..., and the rest; the least of an opening is the least of its pieces.
        scales = np.array([openings(n) for n in counts.tolist()], np.int64)
        pieces = scales + 1
        first = np.cumsum(pieces) - pieces
        nth = np.arange(pieces.sum()) - np.repeat(first, pieces)
        cuts = np.repeat(at, pieces) + np.where(nth > 0, OPENING << np.maximum(nth - 1, 0), 0)
        least = np.empty((len(cuts), BANDS * ROWS), np.uint64)
        with np.errstate(over="ignore"):
            for i in range(BANDS * ROWS):
                least[:, i] = np.minimum.reduceat(grams * self.times[i] + self.plus[i], cuts)
            for n in range(1, int(pieces.max(initial=0))):
                later = np.flatnonzero(nth == n)
                least[later] = np.minimum(least[later], least[later - 1])
            keys = (least.reshape(-1, BANDS, ROWS) * self.mix).sum(axis=2, dtype=np.uint64) ^ np.arange(BANDS, dtype=np.uint64)
            # The last piece closes the whole text; the others are openings, told apart by their length.
            scale = np.where(nth == np.repeat(scales, pieces), 0, nth + 1).astype(np.uint64)
            keys += (scale * np.uint64(0x9E3779B97F4A7C15))[:, None]
        listed = np.where(nth == 0, np.repeat(first + scales, pieces), np.arange(len(cuts)) - 1)  # the whole first, then the openings
        keys = keys[listed].reshape(-1).view(np.int64).tolist()
        banded = [keys[f * BANDS : (f + p) * BANDS] if n else [] for f, p, n in zip(first.tolist(), pieces.tolist(), sizes)]
        long = sizes > WORDS
        last = at + counts - 1
        before = np.where(long, last - 1, last)
        with np.errstate(over="ignore"):
            tails = np.where(long, grams[last] * np.uint64(0x9E3779B97F4A7C15) + grams[before], np.uint64(0))
        return banded, grams[before].view(np.int64), tails.view(np.int64)


def openings(count: int) -> int:
    """How many openings of 8, 16, ... shingles, all shorter than itself, a text of count shingles has."""
    return ((count - 1) // OPENING).bit_length()


_ENDS = "key {kind}, source string, digest long, body_digest long, chars long, octets long, body_chars long, body_octets long, words long, marked boolean, sentence boolean, closer string, shape long, lines array<struct<shape:long,closer:string>>, bands array<long>, stop long, tail long"


def _ends(judge: Pages, batch: pa.RecordBatch, constants: list[set[int]]) -> Iterator[pa.RecordBatch]:
    sign = Signer()
    rows, kept_rows, signed, waiting, pending = [], [], [], [], 0
    shapes: list[int | None] = []  # None: of its line's form, told for the whole batch at the end
    closers: list[str] = []
    bounds = [0]
    formed: list[str] = []  # the lines of those, then last lines
    ending: list[int | None] = []

    def shape(line: str, worded: int, shapes: list[int | None]) -> None:
        """Titles are one shape, whatever they are about; what has a list mark is none."""
        if line[0] not in MARKS and worded in judge.titles:
            shapes.append(1)
        else:
            shapes.append(None)
            formed.append(line)

    lasts: list[tuple[str, int]] = []

    texts, sources = batch.column("text").to_pylist(), batch.column("source_").to_pylist()
    for row, (page, outside, ragged) in enumerate(judge.judged(batch, constants)):
        text = texts[row]
        if not text or text.isspace():
            continue
        kept_rows.append(row)
        drop = set(outside)
        kept = [(x, w) for n, (x, w) in enumerate(zip(page.text, page.worded), 1) if n not in drop]
        own = [(x.rstrip(), w) for x, w in kept if not x.isspace() and x]
        body = "\n".join([x for x, _ in kept]).strip("\n")
        last, last_worded = own[-1] if own else ("", 0)
        marked = ragged or omitted(text.rstrip()) or omitted(last)
        dots = before_dots(last)
        for x, worded in own[:-1]:
            if "..." in x:
                dotted = ["..." + w for w in _DOTTED.findall(x)]
                shapes += [0] * len(dotted)
                closers += dotted
            elif not (x[-1] in SENTENCE_ENDS or x[-1] in CLOSERS and ends_sentence(x)):
                shape(x, worded, shapes)
                closers.append(closing(x))
        bounds.append(len(shapes))
        words, whole, part = body.split(), text.encode("utf-8", "surrogatepass"), body.encode("utf-8", "surrogatepass")
        complete = not last or dots is None and (ends_sentence(last) or bool(_LINK.match(last.strip())))
        lasts.append(("" if complete or dots is not None else last, last_worded))
        rows.append((
            sources[row], _hash(whole), _hash(part), len(text), len(whole), len(body), len(part), len(words), marked,
            complete, None if complete else closing(last) if dots is None else "..." + dots,
        ))
        waiting.append(words)
        pending += len(words)
        if pending > 300_000:  # whole texts, in bounded memory
            signed.append(sign.bands(waiting))
            waiting, pending = [], 0
    signed.append(sign.bands(waiting))
    for (last, worded), row in zip(lasts, rows):
        if last:
            shape(last, worded, ending)
        else:
            ending.append(None if row[9] else 0)
    told = iter(hashes(pa.array(forms(formed), pa.string())).tolist())
    shapes = [next(told) if n is None else n for n in shapes]
    ending = [next(told) if n is None and last else n for n, (last, _) in zip(ending, lasts)]
    names = "source digest body_digest chars octets body_chars body_octets words marked sentence closer".split()
    kinds = [pa.string(), *[pa.int64()] * 7, pa.bool_(), pa.bool_(), pa.string()]
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    lines = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays([pa.array(shapes, pa.int64()), pa.array(closers, pa.string())], ["shape", "closer"]))
    bands = pa.array([b for s in signed for b in s[0]], pa.list_(pa.int64()))
    stops, tails = (pa.array(np.concatenate([s[i] for s in signed]), pa.int64()) for i in (1, 2))
    yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(kept_rows, pa.int32())), *[pa.array(list(c), k) for c, k in zip(columns, kinds)], pa.array(ending, pa.int64()), lines, bands, stops, tails], ["key", *names, "shape", "lines", "bands", "stop", "tail"])


MEASURES = ("chars", "octets", "body_chars", "body_octets")


def length_limits(ends: DataFrame) -> DataFrame:
    """source, measure, length: lengths at which a source piles up different texts.

    At least three texts where hardly any of the source are longer, else far more than the lengths around have.
    """
    # Equal texts of a source count once; their rows meet before each becomes four.
    texts = ends.where(F.col("source").isNotNull()).select("source", "digest", *MEASURES).distinct()
    single = texts.select("source", F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("length")) for m in MEASURES])).alias("x")).select("source", "x.*").where("length > 0")
    counts = cut_lineage(single.groupBy("source", "measure", "length").agg(F.count("*").alias("n")))
    # What lies around is summed in bins of twenty lengths: a bin and its neighbours.
    binned = counts.withColumn("bin", F.floor(F.col("length") / 20))
    of = W.partitionBy("source", "measure")
    bins = binned.groupBy("source", "measure", "bin").agg(F.sum("n").alias("in_bin")).withColumns({"near": F.sum("in_bin").over(of.orderBy("bin").rangeBetween(-1, 1)), "all": F.sum("in_bin").over(of)})
    longer = F.coalesce(F.sum("n").over(of.orderBy(F.desc("length")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    seen = binned.withColumn("longer", longer).where("n >= 3").join(bins, ["source", "measure", "bin"]).withColumn("level", (F.col("near") - F.col("n")) / 59)
    top = F.col("longer") <= 0.005 * F.col("all")
    return seen.where(top | (F.col("n") >= F.col("level") + 5 * F.sqrt("level") + 5)).select("source", "measure", "length")


def _limits_by_source(ends: DataFrame) -> DataFrame:
    """source and, for each measure, the lengths at which it piles up (few a source); of a body a blank at the cut may be lost."""
    limits = cut_lineage(length_limits(ends))
    near = limits.unionByName(limits.where("measure like 'body%'").withColumn("length", F.col("length") - 1))
    return near.groupBy("source").agg(*[F.collect_set(F.when(F.col("measure") == m, F.col("length"))).alias(f"{m}_limits") for m in MEASURES])


def _line_closings(ends: DataFrame, least: float = 2e-5) -> tuple[DataFrame, DataFrame]:
    """(shape, open) of the usual wordings of complete lines, and the closers that complete lines have."""
    inner = ends.select(F.explode("lines").alias("x")).select("x.shape", "x.closer").groupBy("shape", "closer").agg(F.count("*").alias("n"))
    # Last lines are complete more often than not: a wording that three in ten thousand end with, and mostly with words that recur there, is a usual one.
    last = ends.where("shape <> 0").groupBy("shape", "closer").agg(F.count("*").alias("n"))
    often = last.groupBy("shape").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("n") >= 3, F.col("n")).otherwise(0)).alias("again")).where("again >= 0.5 * n").join(F.broadcast(ends.agg(F.count("*").alias("all"))), F.col("n") >= F.greatest(F.lit(5.0), F.col("all") * 0.0003)).select("shape")
    shaped = cut_lineage(inner.unionByName(last.join(often, "shape", "left_semi")).groupBy("shape", "closer").agg(F.sum("n").alias("n")))
    total = F.broadcast(shaped.agg(F.sum("n").alias("all")))
    shapes = shaped.groupBy("shape").agg(F.sum("n").alias("n")).join(total, F.col("n") >= F.greatest(F.lit(5.0), F.col("all") * least)).select("shape")
    usual = cut_lineage(shaped.join(shapes, "shape", "left_semi"))
    capital = F.col("closer").startswith("~")
    closers = usual.groupBy("closer").agg(F.sum("n").alias("n"))
    sums = F.broadcast(closers.agg(F.sum(F.when(capital, F.col("n"))).alias("capitals"), F.sum("n").alias("all")))
    enough = F.when(capital, F.col("n") >= F.greatest(F.lit(3.0), F.col("capitals") * 0.005)).otherwise(F.col("n") >= F.greatest(F.lit(3.0), F.col("all") * least))
    known = cut_lineage(closers.join(sums, enough).select("closer", F.lit(True).alias("closes")))
    shares = usual.join(known, "closer", "left").groupBy("shape").agg((F.sum(F.when(F.col("closes").isNull(), F.col("n")).otherwise(0)) / F.sum("n")).alias("open"))
    return cut_lineage(shares), known


def _cut_copies(ends: DataFrame, wrapper: Wrapper) -> DataFrame:
    """body_digest of the bodies whose alignment with any longer near-copy ends early. Equal bodies stand for one.

    No pairs of all members of a band are made. First every text meets the longest of each of its bands,
    which finds the cut ones of a group of copies. A text that is not found so can only be cut inside a
    longer text that holds its last shingle: such texts of its bands are looked up by that shingle.
    """
    kind = dict(ends.dtypes)["key"]
    slots = ends.select("body_digest", "key", "words", F.col("body_chars").alias("chars"), "stop", "tail", F.size("bands").alias("n"), F.posexplode("bands").alias("at", "band"))
    # A text that may be a cut copy is known by its whole and its longest opening, over half of it; the openings of the longer text meet both.
    asks = (F.col("at") < BANDS) | (F.col("at") >= F.col("n") - BANDS)
    slots = slots.withColumn("asks", asks).drop("n", "at")
    # Texts of the same last six words end together; a band of one ending has none that is cut inside another.
    differ = (F.min("tail") != F.max("tail")) | (F.min("tail") == 0)
    shared = cut_lineage(slots.groupBy("band").agg(F.count("*").alias("n"), F.bool_or("asks").alias("asked"), differ.alias("differ")).where("n > 1 and asked and differ").select("band", "n"))
    hot = cut_lineage(shared.join(F.broadcast(shared.agg(F.sum("n").alias("all"))), F.col("n") >= F.greatest(F.lit(100), F.col("all") * 0.005)).select("band"))  # two hundred at most
    met = lookup_join(slots, shared.drop("n"), ["band"], how="inner", hot=hot)
    met = cut_lineage(met.groupBy("band", "body_digest", "words", "chars", "stop", "tail").agg(F.min("key").alias("key"), F.bool_or("asks").alias("asks")))
    bodies = cut_lineage(map_pages(wrapper.pages.join(met.select("key").distinct(), "key", "left_semi"), wrapper, body_rows, f"key {kind}, body string"))

    longer = "(words < most or words = most and chars < most_chars) and (tail = 0 or tail <> other_tail)"
    whole = F.struct(F.col("key").alias("longer"), F.col("words").alias("most"), F.col("chars").alias("most_chars"), F.col("tail").alias("other_tail"))
    tops = met.groupBy("band").agg(F.max_by(whole, F.struct("words", "chars", "key")).alias("top")).select("band", "top.*")
    asking = met.where("asks").drop("asks")
    tried = lookup_join(asking, cut_lineage(tops), ["band"], how="inner", hot=hot).where(longer).select("body_digest", "key", "longer").distinct()
    found = cut_lineage(_verified(tried, bodies))

    left = cut_lineage(asking.join(found, "body_digest", "left_anti"))
    asked = left.groupBy("body_digest", "key", "words", "chars", "stop", "tail").agg(F.collect_set("band").alias("bands"))  # two sets of BANDS at most
    in_bands = lookup_join(met, cut_lineage(left.select("band").distinct()), ["band"], how="inner", hot=hot)
    wholes = in_bands.groupBy(F.col("key").alias("longer"), F.col("words").alias("most"), F.col("chars").alias("most_chars"), F.col("tail").alias("other_tail")).agg(F.collect_set("band").alias("their_bands"))
    inner = cut_lineage(bodies.join(wholes.select(F.col("longer").alias("key")), "key", "left_semi").mapInPandas(_inner_shingles, f"longer {kind}, stop long"))
    holding = cut_lineage(lookup_join(inner, cut_lineage(asked.select("stop", F.lit(True).alias("wanted")).distinct()), ["stop"], how="inner").drop("wanted"))
    pairs = asked.join(holding, "stop").join(wholes, "longer").where(longer).where(F.arrays_overlap("bands", "their_bands"))
    return found.unionByName(_verified(pairs.select("body_digest", "key", "longer").distinct(), bodies)).distinct()


def _inner_shingles(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """longer, stop: the shingles of each body but its last, behind which nothing follows; repeats within the body once."""
    for frame in frames:
        found = [np.unique(Signer.shingles(body.split())[:-1].view(np.int64)) for body in frame["body"]]
        yield pd.DataFrame({"longer": frame["key"].repeat([len(g) for g in found]).to_numpy(), "stop": np.concatenate(found) if found else np.zeros(0, np.int64)})


def _verified(pairs: DataFrame, bodies: DataFrame) -> DataFrame:
    """body_digest of the pairs (body_digest, key, longer) whose text ends early in the longer one."""
    short = cut_lineage(pairs.join(bodies, "key").drop("key"))
    both = lookup_join(short, bodies.withColumnsRenamed({"key": "longer", "body": "whole"}), ["longer"], how="inner")

    def align(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            early = [ends_early(a.split(), b.split()) for a, b in zip(frame["body"], frame["whole"])]
            yield frame.loc[early, ["body_digest"]]

    return both.select("body_digest", "body", "whole").mapInPandas(align, "body_digest long").distinct()


def ends_early(short: list[str], whole: list[str]) -> bool:
    """Whether short is a near-copy of whole (0.8 of its five-word shingles are there) that stops inside it; its last word may be cut."""
    if len(short) > len(whole) or short == whole:
        return False
    words = short[:-1] if len(short) > WORDS else short
    if " ".join(words[-WORDS:]) not in " ".join(whole):  # most pairs end here: the last shingle must be in whole
        return False
    mine, other = Signer.shingles(words), Signer.shingles(whole)
    places = {gram: i for i, gram in enumerate(other.tolist())}
    own = set(mine.tolist())
    if len(own & places.keys()) < SIMILAR * len(own):
        return False
    at = places.get(int(mine[-1]))
    if at is None:
        return False
    # What follows in whole must be more than the word left off above.
    rest = whole[at + WORDS :]
    last = short[-1] if len(short) > WORDS else ""
    return len(rest) > 1 or (len(rest) == 1 and rest[0] != last and rest[0].startswith(last))


def truncated(df: DataFrame, key: str = "doc_id", text: str = "text", url: str = "source_url", lang: str = "lang", source: str = "source") -> DataFrame:
    """key, source, reason: the records whose text, or whose main body, was cut before its end.

    reason is the first of 'copy', 'limit', 'mark' and 'closing' that tells. Null, empty and blank
    texts are not cut, nor are texts without a main body. Records with a null source have no limit of their own. Texts are read whole;
    rows with the same key are judged each, and the key is listed once. Other columns are ignored.
    """
    pages = pages_of(df.withColumn("source_", F.col(source)), key, text, url, lang, extra=("source_",))
    wrapper = induce(pages)
    kind = dict(pages.dtypes)["key"]
    ends = cut_lineage(map_pages(wrapper.pages, wrapper, _ends, _ENDS.format(kind=kind), ("source_",)))
    shapes, known = _line_closings(ends)
    limited = F.lit(False)
    for m in MEASURES:
        limited = limited | F.coalesce(F.array_contains(f"{m}_limits", F.col(m)), F.lit(False))
    placed = lookup_join(ends.select("key", "source", "body_digest", "marked", "sentence", "shape", "closer", *MEASURES), cut_lineage(_limits_by_source(ends)), ["source"])
    shaped = cut_lineage(placed.select("key", "source", "body_digest", "marked", "sentence", "shape", "closer", limited.alias("limited")))
    judged = cut_lineage(lookup_join(cut_lineage(lookup_join(shaped, shapes, ["shape"])), known, ["closer"]))
    closes = F.when(F.col("sentence"), True).when(F.col("shape") == 0, F.col("closes").isNotNull()).otherwise(F.col("open").isNotNull() & (F.col("closes").isNotNull() | (F.col("open") > 0.3)))
    copies = cut_lineage(_cut_copies(ends, wrapper)).withColumn("copied", F.lit(True))
    told = lookup_join(judged.withColumn("closed", closes), copies, ["body_digest"])
    reason: Column = F.when(F.col("copied"), "copy").when(F.col("limited"), "limit").when(F.col("marked"), "mark").when(~F.col("closed"), "closing")
    return told.withColumn("reason", reason).where("reason is not null").groupBy("key").agg(F.min("source").alias("source"), F.min("reason").alias("reason")).withColumnRenamed("key", key)


def truncation_rates(df: DataFrame, found: DataFrame, key: str = "doc_id", source: str = "source") -> DataFrame:
    """source, records, cut, share: how often each source truncates, of its records with a key; null is a source of its own."""
    flagged = df.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(source).alias("source")).join(found.select(F.col(key).alias("key"), F.lit(1).alias("cut")), "key", "left")
    counts = flagged.groupBy("source").agg(F.count("*").alias("records"), F.sum(F.coalesce("cut", F.lit(0))).alias("cut"))
    return counts.withColumn("share", F.round(F.col("cut") / F.col("records"), 6))
