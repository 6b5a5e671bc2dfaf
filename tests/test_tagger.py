"""The learned recogniser of names."""

from __future__ import annotations

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from checks.registered import LEARNED
from stewardry.operators import tagger as T
from stewardry.operators.people import attach_spans
from stewardry.plans.extraction import process_pages, with_sections

LABELLED = "section string, spans array<struct<start:int,text:string>>"


def score(model, features, tags):
    total, before = 0.0, 3
    for row, tag in zip(features, tags, strict=True):
        total += model.weights[row, tag].sum() + model.moves[before, tag]
        before = tag
    return total


@pytest.mark.parametrize("seed", range(5))
def test_decoding_finds_the_best_of_all_sequences(seed):
    rng = np.random.default_rng(seed)
    model = T.Tagger(rng.normal(size=(1 << T.BITS, 3)), rng.normal(size=(4, 3)) * 3)
    for section in ("CEO Ann Lee spoke.", "a", "J. P. Morgan, of New York", "Tom"):
        features = T.features_of(T.tokens_of(section))
        allowed = [t for t in itertools.product(range(3), repeat=len(features))
                   if t[0] != T.INSIDE and all(not (b == T.INSIDE and a == T.OUTSIDE) for a, b in itertools.pairwise(t))]
        best = max(allowed, key=lambda t: score(model, features, t))
        assert score(model, features, model.decode(features)) == pytest.approx(score(model, features, best))


def test_tags_and_names_go_both_ways():
    section = "CEO Ann Lee, Bob O'Neil-Ray met Ann Lee Zoe Fox."
    spans = [(4, 11), (13, 27), (32, 39), (40, 47)]
    tags = T.tags_of(T.tokens_of(section), spans)
    assert tags == [0, 1, 2, 0, 1, 2, 0, 1, 2, 1, 2, 0]

    class Fixed(T.Tagger):
        def decode(self, features):
            return tags

    assert Fixed().names(section) == [(section[a:b], a) for a, b in spans]
    assert T.Tagger().names("") == T.Tagger().names(None) == []


def sentences(n, seed):
    rng = np.random.default_rng(seed)
    first, last = ["Ann", "Bob", "Zoe", "Ida", "Karl", "Tom"], ["Lee", "Ray", "Fox", "Huber", "Weiss"]
    out = []
    for _ in range(n):
        name = f"{rng.choice(first)} {rng.choice(last)}"
        text = rng.choice(["Our CEO {} spoke.", "The Board met {} in New York.", "{}, Director, left.", "No one was there.", "Call the Gold Mine office or {}."])
        out.append((text.format(name), [(text.index("{}"), name)] if "{}" in text else []))
    return out


def test_it_learns_what_it_is_shown(spark):
    model = T.train(spark.createDataFrame(sentences(400, 1), LABELLED))
    for text, spans in sentences(200, 2):
        assert model.names(text) == [(name, at) for at, name in spans]


def test_training_does_not_depend_on_the_layout(spark):
    rows = sentences(200, 3)
    one = T.train(spark.createDataFrame(rows, LABELLED), sample=100, epochs=2)
    other = T.train(spark.createDataFrame(rows[::-1], LABELLED).repartition(7), sample=100, epochs=2)
    np.testing.assert_allclose(one.weights, other.weights, atol=1e-9)
    assert not T.train(spark.createDataFrame([], LABELLED), epochs=1).weights.any()


def test_it_plugs_in_as_a_recogniser(spark):
    model = T.train(spark.createDataFrame(sentences(400, 1), LABELLED))
    pages = spark.createDataFrame([("https://x.com/a", "T", "a.json", "Our CEO Zoe Huber spoke. Nothing else.", None)],
                                  "url string, title string, source_file string, body_text string, sections string")
    spanned = attach_spans(with_sections(pages), model.recogniser, "relevant")
    row = process_pages(spanned, spans="spans").first()
    assert [(p["name"], p["role"]) for p in row["executives"]] == [("Zoe Huber", "Chief Executive Officer")]


def test_held_out_pages_agree_with_the_rule(spark):
    assert set(LEARNED) <= set(entry_point.queries()) and not set(LEARNED) & set(entry_point.oracle_sql())
    found = entry_point.queries()["learned_names"](spark, "/root/testdata/sf0.001").where("held_out")
    both, tagged, ruled = found.agg(
        F.count_if(F.col("by_tagger") & F.col("by_rule")), F.count_if("by_tagger"), F.count_if("by_rule")).first()
    assert both >= 0.95 * tagged and both >= 0.95 * ruled and both > 300


def test_kept_scores_give_the_tags_of_all_features():
    import random

    import numpy as np

    from stewardry.operators import tagger as G

    rng, numbers = random.Random(5), np.random.default_rng(5)
    model = G.Tagger(numbers.normal(size=(1 << G.BITS, 3)), numbers.normal(size=(4, 3)))
    words = ["Ann", "Lee", "ß", "Élan", "CEO", ".", ",", "42nd", "o'Neil", "of", "İda"]
    find, scores = model.recogniser(), model.scores()
    for _ in range(300):
        section = " ".join(rng.choice(words) for _ in range(rng.randrange(30)))
        tokens = G.tokens_of(section)
        features = G.features_of(tokens)
        assert scores(tokens) == (model.weights[features].sum(1).tolist() if tokens else [])
        assert find(section) == model._named(section, tokens, model.decode(features))
    assert find(None) == find("") == []


def plain_pass(model, rows):
    """The averaged perceptron, one section after the other."""
    now, sums, step = T.Tagger(model.weights.copy(), model.moves.copy()), T.Tagger(), 1
    for section, spans in rows:
        tokens = T.tokens_of(section)
        features = T.features_of(tokens)
        found, wanted = now.decode(features), T.tags_of(tokens, spans)
        for tags, sign in ((wanted, 1.0), (found, -1.0)) if found != wanted else ():
            before = 3
            for row, tag in zip(features, tags, strict=True):
                np.add.at(now.weights[:, tag], row, sign)
                np.add.at(sums.weights[:, tag], row, sign * step)
                now.moves[before, tag] += sign
                sums.moves[before, tag] += sign * step
                before = tag
        step += 1
    return now, T.Tagger(now.weights - sums.weights / step, now.moves - sums.moves / step)


def test_a_pass_is_that_of_one_section_after_the_other():
    rng = np.random.default_rng(7)
    rows = [(text, [(at, at + len(name)) for at, name in spans], int(rng.choice([1, 1, 2, 9]))) for text, spans in sentences(300, 5)]
    rows += [(" \t", [], 3), ("Ann Lee Ann Lee", [(0, 15)], 6), ("Ann Lee Ann Lee", [(0, 7), (8, 15)], 6), ("İda Öz, ß.", [(0, 6)], 2)]
    rows = [rows[i] for i in rng.permutation(len(rows))]
    each = [(text, spans) for text, spans, times in rows for _ in range(times)]
    ours = plain = T.Tagger()
    for _ in range(2):
        (ours, our_mean), (plain, plain_mean) = T._learned(ours, rows), plain_pass(plain, each)
        for a, b in ((ours, plain), (our_mean, plain_mean)):
            np.testing.assert_allclose(a.weights, b.weights, atol=1e-9)
            np.testing.assert_allclose(a.moves, b.moves, atol=1e-9)
    assert our_mean.weights.any()
    empty, mean = T._learned(T.Tagger(), [])
    assert not empty.weights.any() and not mean.weights.any()


def test_every_section_is_learned_from(spark):
    """Words that only sections behind the first 20,000 in hash order have get weights as well."""
    rows = [(f"Item {i} was sold.", []) for i in range(42_000)] + [(f"Item {i} by zed quill.", [(len(f"Item {i} by "), "zed quill")]) for i in range(800)]
    key = F.xxhash64("section")
    labelled = spark.createDataFrame(rows, LABELLED).where(F.when(F.size("spans") == 0, key < 0).otherwise(key >= 0))
    assert labelled.where(key < 0).count() > 20_000 and labelled.where(key >= 0).count() > 300
    model = T.train(labelled, epochs=1)
    seen = T.features_of(T.tokens_of("zed quill"))[:, 0]
    assert model.weights[seen].any(1).all()


def test_frequent_sections_are_shared_out(spark, monkeypatch):
    monkeypatch.setattr(T, "PART_TIMES", 10)
    counted = spark.createDataFrame([("a", [], 3, 5, 7), ("b", [], 3, 6, 47), ("c", [], 3, -7, 1000)],
                                    "section string, spans array<struct<start:int,end:int>>, label long, key long, times long")
    times = {}
    for r in T._dealt(counted, 8).collect():
        times.setdefault(r["section"], {})[r["part"]] = r["times"]
    assert times == {"a": {5: 7}, "b": {6: 10, 7: 10, 0: 9, 1: 9, 2: 9}, "c": dict.fromkeys(range(8), 125)}


def test_the_query_learns_from_all_pages_that_are_not_held_out(spark, monkeypatch):
    given, train = [], T.train
    monkeypatch.setattr(T, "train", lambda labelled, **more: given.append((labelled.count(), more)) or train(labelled, epochs=1, **more))
    entry_point.queries()["learned_names"](spark, "/root/testdata/sf0.001")
    assert len(given) == 1 and given[0][0] > 0 and given[0][1] == {}
