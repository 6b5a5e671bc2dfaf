"""Names of persons by a learned sequence tagger.

Tokens of a section are tagged as the begin of a name, inside of one, or neither. A tag's
score is the sum of hashed features of the token and its neighbours (the word, its shape,
its first and last letters) and of the tag before; Viterbi decoding finds the best sequence.
Weights are those of an averaged perceptron, trained in Spark by mixing: in each epoch
every part of the labelled sections goes on from the same weights, and the results are
averaged. Every labelled section is learned from, as often as it occurs. Labels may come from
the rule (`functions.people.person_spans`) or from anywhere.

The tagger plugs in where any recogniser does: `people.attach_spans(pages,
tagger.recogniser, "relevant")`, then `process_pages(spans="spans")`.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stewardry.functions.people import person_spans
from stewardry.session import written

# Python workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

OUTSIDE, BEGIN, INSIDE = 0, 1, 2
#: log2 of the number of hashed features; weights are three numbers for each.
BITS = 18
#: Parts that labelled sections are dealt to at least, and epochs.
PARTS, EPOCHS = 8, 4
#: Characters of different sections in a part, about; times a section comes in a part, about.
PART_CHARS, PART_TIMES = 4 << 20, 1000
#: Sections that are scored at once at most.
AHEAD = 64

#: Words and neighbourhoods whose scores a task keeps at most.
KEPT = 200_000

_TOKEN = re.compile(r"\w[\w'’-]*|[^\w\s]")
_WEIGHTS = "feature long, tag long, weight double, mean double"


def tokens_of(section: str) -> list[tuple[int, int, str]]:
    """(start, end, text) of words and marks."""
    return [(m.start(), m.end(), m.group()) for m in _TOKEN.finditer(section)]


def _shape(word: str) -> str:
    shape = re.sub(r"[a-zß-öø-ÿ]+", "x", re.sub(r"[A-ZÀ-ÖØ-Þ]", "X", re.sub(r"\d+", "d", word)))
    return shape[:6]


def features_of(tokens: list[tuple[int, int, str]]) -> np.ndarray:
    """The hashed features of each token, a row each."""
    words = ["<", *(t for _, _, t in tokens), ">"]
    lower, shapes = [w.lower() for w in words], [_shape(w) for w in words]
    rows = []
    for i in range(1, len(words) - 1):
        given = (
            f"w {lower[i]}", f"s {shapes[i]}", f"a {lower[i][:3]}", f"z {lower[i][-3:]}", f"p {lower[i - 1]}", f"n {lower[i + 1]}",
            f"t {shapes[i - 1]} {shapes[i]}", f"u {shapes[i]} {shapes[i + 1]}", f"v {shapes[i - 1]} {shapes[i]} {shapes[i + 1]}", "b",
        )
        rows.append([zlib.crc32(g.encode()) & ((1 << BITS) - 1) for g in given])
    return np.array(rows, np.int64) if rows else np.zeros((0, 1), np.int64)


def tags_of(tokens: list[tuple[int, int, str]], spans: list[tuple[int, int]]) -> list[int]:
    """The tags that names at (start, end) give the tokens; a token counts if it begins in a name."""
    out, spans, at = [], sorted(spans), 0
    for start, _, _ in tokens:
        while at < len(spans) and spans[at][1] <= start:
            at += 1
        inside = at < len(spans) and spans[at][0] <= start
        first = inside and (not out or tokens[len(out) - 1][0] < spans[at][0])
        out.append(BEGIN if first else INSIDE if inside else OUTSIDE)
    return out


class Tagger:
    """Weights of features (a row of three for each) and of tags after tags (the last row: at
    the start of a section)."""

    def __init__(self, weights: np.ndarray | None = None, moves: np.ndarray | None = None):
        self.weights = np.zeros((1 << BITS, 3)) if weights is None else weights
        self.moves = np.zeros((4, 3)) if moves is None else moves

    def decode(self, features: np.ndarray) -> list[int]:
        """The best tags. Inside follows begin or inside alone; of equal scores the lower tag wins."""
        if not len(features):
            return []
        return _best_tags(self.weights[features].sum(1).tolist(), self.moves.tolist())

    def scores(self) -> Callable[[list[tuple[int, int, str]]], list[list[float]]]:
        """The sums of `weights[features_of(tokens)]` for the tokens of a section, three each.

        What a word and what a neighbourhood adds is looked up once and kept. All is added in
        the order of the features, so that the sums are the same to the last bit.
        """
        weights, words, shapes = self.weights, {}, {}

        def of(feature: str) -> tuple[float, float, float]:
            return tuple(weights[zlib.crc32(feature.encode()) & ((1 << BITS) - 1)].tolist())

        def of_word(word: str):
            lower, shape = word.lower(), _shape(word)
            own = (0.0, 0.0, 0.0)
            for f in (f"w {lower}", f"s {shape}", f"a {lower[:3]}", f"z {lower[-3:]}"):
                own = tuple(x + y for x, y in zip(own, of(f), strict=True))
            return own, of(f"p {lower}"), of(f"n {lower}"), shape

        def of_shapes(a: str, b: str, c: str):
            return of(f"t {a} {b}"), of(f"u {b} {c}"), of(f"v {a} {b} {c}"), of("b")

        def word(text: str):
            found = words.get(text)
            if found is None:
                if len(words) >= KEPT:
                    words.clear()
                found = words[text] = of_word(text)
            return found

        def section_scores(tokens: list[tuple[int, int, str]]) -> list[list[float]]:
            row = [word("<"), *(word(t) for _, _, t in tokens), word(">")]
            out = []
            for (_, before, _, a), (own, _, _, b), (_, _, after, c) in zip(row, row[1:], row[2:], strict=False):
                around = shapes.get((a, b, c))
                if around is None:
                    if len(shapes) >= KEPT:
                        shapes.clear()
                    around = shapes[a, b, c] = of_shapes(a, b, c)
                t, u, v, w = around
                out.append([
                    own[0] + before[0] + after[0] + t[0] + u[0] + v[0] + w[0],
                    own[1] + before[1] + after[1] + t[1] + u[1] + v[1] + w[1],
                    own[2] + before[2] + after[2] + t[2] + u[2] + v[2] + w[2],
                ])
            return out

        return section_scores

    def names(self, section: str | None) -> list[tuple[str, int]]:
        """(name, start) of the names found."""
        tokens = tokens_of(section or "")
        return self._named(section, tokens, self.decode(features_of(tokens)))

    def _named(self, section: str, tokens: list[tuple[int, int, str]], tags: list[int]) -> list[tuple[str, int]]:
        spans: list[list[int]] = []
        for (start, end, _), tag in zip(tokens, tags, strict=True):
            if tag == BEGIN:
                spans.append([start, end])
            elif tag == INSIDE:
                spans[-1][1] = end
        return [(section[a:b], a) for a, b in spans]

    def recogniser(self) -> Callable[[str], list[tuple[str, int]]]:
        """What `operators.people.attach_spans` asks for."""
        scores, moves = self.scores(), self.moves.tolist()

        def names(section: str | None) -> list[tuple[str, int]]:
            tokens = tokens_of(section or "")
            return self._named(section, tokens, _best_tags(scores(tokens), moves)) if tokens else []

        return names


def _best_tags(own: list[list[float]], moves: list[list[float]]) -> list[int]:
    """Viterbi, see `Tagger.decode`."""
    (oo, ob, _), (bo, bb, bi), (io, ib, ii), (so, sb, _) = moves
    o, b, i = own[0][OUTSIDE] + so, own[0][BEGIN] + sb, -np.inf
    back = []
    for to_o, to_b, to_i in own[1:]:
        x, y, z = o + oo, b + bo, i + io
        from_o, best_o = (OUTSIDE, x) if x >= y and x >= z else (BEGIN, y) if y >= z else (INSIDE, z)
        x, y, z = o + ob, b + bb, i + ib
        from_b, best_b = (OUTSIDE, x) if x >= y and x >= z else (BEGIN, y) if y >= z else (INSIDE, z)
        y, z = b + bi, i + ii
        from_i, best_i = (BEGIN, y) if y >= z else (INSIDE, z)
        o, b, i = best_o + to_o, best_b + to_b, best_i + to_i
        back.append((from_o, from_b, from_i))
    tags = [OUTSIDE if o >= b and o >= i else BEGIN if b >= i else INSIDE]
    for came in reversed(back):
        tags.append(came[tags[-1]])
    return tags[::-1]


def _coded(sections: list[list[tuple[int, int, str]]]) -> tuple[np.ndarray, np.ndarray]:
    """The features of the tokens of all sections, as `features_of`, and where each section's begin.

    What a word and what a neighbourhood has is worked out once for all sections.
    """
    mask = (1 << BITS) - 1
    numbers, shapes, words, kinds = {}, {}, [], []

    def hashed(*features: str) -> list[int]:
        return [zlib.crc32(f.encode()) & mask for f in features]

    def number(word: str) -> int:
        found = numbers.get(word)
        if found is None:
            found = numbers[word] = len(numbers)
            lower, shape = word.lower(), _shape(word)
            kinds.append(shapes.setdefault(shape, len(shapes)))
            words.append(hashed(f"w {lower}", f"s {shape}", f"a {lower[:3]}", f"z {lower[-3:]}", f"p {lower}", f"n {lower}"))
        return found

    begins = np.zeros(len(sections) + 1, np.int64)
    np.cumsum([len(tokens) for tokens in sections], out=begins[1:])
    first, last = number("<"), number(">")
    codes = np.array([c for tokens in sections for c in (first, *(number(t) for _, _, t in tokens), last)], np.int64)
    # a section's tokens stand between two numbers that are no token's
    at = np.arange(begins[-1]) + np.repeat(2 * np.arange(len(sections)) + 1, np.diff(begins))
    words, kinds, names = np.array(words, np.int32), np.array(kinds, np.int64), list(shapes)
    a, b, c = (kinds[codes[at + i]] for i in (-1, 0, 1))
    around, which = np.unique((a * len(names) + b) * len(names) + c, return_inverse=True)
    rows = []
    for n in around.tolist():
        a, b, c = names[n // len(names) ** 2], names[n // len(names) % len(names)], names[n % len(names)]
        rows.append(hashed(f"t {a} {b}", f"u {b} {c}", f"v {a} {b} {c}", "b"))
    rows = np.array(rows, np.int32).reshape(-1, 4)
    return np.concatenate([words[codes[at], :4], words[codes[at - 1], 4:5], words[codes[at + 1], 5:], rows[which]], axis=1), begins


def _learned(tagger: Tagger, rows: Iterable[tuple[str, list[tuple[int, int]], int]]) -> tuple[Tagger, Tagger]:
    """One pass of the perceptron: the weights after it, and their mean over all steps.

    A row is a section, its names at (start, end), and how many times it is learned from, one
    after the other; once it is tagged right, the times that are left change no weight.
    Sections are scored some at once, and anew when weights have changed.
    """
    rows = [(tokens_of(section), spans, times) for section, spans, times in rows]
    features, begins = _coded([tokens for tokens, _, _ in rows])
    now, sums, step = Tagger(tagger.weights.copy(), tagger.moves.copy()), Tagger(), 1
    at, ahead = 0, 1
    while at < len(rows):
        until = min(at + ahead, len(rows))
        own, moves = now.weights[features[begins[at]:begins[until]]].sum(1).tolist(), now.moves.tolist()
        ahead = min(2 * ahead, AHEAD)
        for i in range(at, until):
            tokens, spans, times = rows[i]
            lo, hi = begins[i], begins[i + 1]
            found, wanted = _best_tags(own[lo - begins[at]:hi - begins[at]], moves) if tokens else [], tags_of(tokens, spans)
            if found == wanted:
                step += times
                continue
            while times and found != wanted:
                _corrected(now, sums, features[lo:hi], wanted, found, step)
                step, times = step + 1, times - 1
                found = now.decode(features[lo:hi]) if times else wanted
            step += times
            until, ahead = i + 1, max(1, i + 1 - at)
            break
        at = until
    return now, Tagger(now.weights - sums.weights / step, now.moves - sums.moves / step)


def _corrected(now: Tagger, sums: Tagger, features: np.ndarray, wanted: list[int], found: list[int], step: int) -> None:
    """Adds the wanted tags and takes the found ones away, where they differ."""
    other = np.flatnonzero(np.array(wanted) != np.array(found))
    rows = features[other]
    for tags, sign in ((wanted, 1.0), (found, -1.0)):
        columns = np.array(tags)[other][:, None]
        np.add.at(now.weights, (rows, columns), sign)
        np.add.at(sums.weights, (rows, columns), sign * step)
        before = 3
        for tag in tags:
            now.moves[before, tag] += sign
            sums.moves[before, tag] += sign * step
            before = tag


def _epoch(start) -> Callable[[pa.Table], pa.Table]:
    """What a part makes of the weights it is given, as rows."""
    def learn(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("key", "ascending"), ("section", "ascending"), ("label", "ascending")]).combine_chunks()
        labels = ([(s["start"], s["end"]) for s in spans.as_py()] for spans in rows["spans"])
        now, average = _learned(Tagger(*start.value), zip(rows["section"].to_pylist(), labels, rows["times"].to_pylist(), strict=True))
        both = [np.concatenate([t.weights, t.moves]) for t in (now, average)]
        feature, tag = np.nonzero((both[0] != 0) | (both[1] != 0))
        return pa.table({"feature": feature, "tag": tag, "weight": both[0][feature, tag], "mean": both[1][feature, tag]})

    return learn


def _dealt(counted: DataFrame, parts: int) -> DataFrame:
    """Sections with their number of `times`, dealt to parts by a hash of their text, whatever
    the layout; one that comes very often is dealt to several, its times being shared out."""
    places = F.least(F.lit(parts), F.ceil(F.col("times") / PART_TIMES))
    shares = F.transform(F.sequence(F.lit(0).cast("long"), places - 1), lambda i: F.struct(
        F.pmod(F.col("key") + i, F.lit(parts)).cast("int").alias("part"),
        F.expr("times div _places").alias("_even"), (i < F.col("times") % F.col("_places")).cast("long").alias("_more")))
    rows = counted.withColumn("_places", places).select("section", "spans", "label", "key", F.inline(shares))
    return rows.withColumn("times", F.col("_even") + F.col("_more")).drop("_even", "_more")


def train(labelled: DataFrame, sample: int | None = None, epochs: int = EPOCHS, parts: int = PARTS) -> Tagger:
    """A tagger learned from `section, spans`, spans being `array<struct<start, text>>`.

    All sections are learned from, unless a `sample` of so many, chosen by a hash of their
    text, is asked for. They stay on the executors, in `parts` or in as many more as keep a
    part's text small. What comes to the driver each epoch is the mean of the parts' weights,
    at most three numbers for each of 2 ** BITS features.
    """
    key = F.xxhash64("section")
    chosen = labelled.select("section", F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), (s["start"] + F.length(s["text"])).alias("end"))).alias("spans"), key.alias("key"))
    chosen = chosen.where("length(section) > 0")
    if sample is not None:
        chosen = chosen.orderBy("key", "section").limit(sample)
    counted = chosen.groupBy("key", "section", "spans").agg(F.count(F.lit(1)).alias("times"))
    counted = written(counted.withColumn("label", F.xxhash64("spans")), "tagged-sections")
    chars = counted.agg(F.sum(F.length("section"))).first()[0] or 0
    parts = max(parts, -(-chars // PART_CHARS))
    dealt = _dealt(counted, parts)
    tagger, mean = Tagger(), Tagger()
    for _ in range(epochs):
        start = counted.sparkSession.sparkContext.broadcast((tagger.weights, tagger.moves))

        found = dealt.groupBy("part").applyInArrow(_epoch(start), _WEIGHTS).groupBy("feature", "tag").agg(
            (F.sum("weight") / parts).alias("weight"), (F.sum("mean") / parts).alias("mean")).toPandas()
        tagger = Tagger()
        for target, name in ((tagger, "weight"), (mean, "mean")):
            whole = np.zeros(((1 << BITS) + 4, 3))
            whole[found["feature"], found["tag"]] = found[name]
            target.weights += whole[:1 << BITS] / (1 if target is tagger else epochs)
            target.moves += whole[1 << BITS:] / (1 if target is tagger else epochs)
        start.destroy()
    return mean


def by_rule(sections: DataFrame) -> DataFrame:
    """`section, spans` with the names that the rule finds, to learn from."""
    return sections.select("section", person_spans("section").alias("spans"))
