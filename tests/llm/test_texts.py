"""Language, quality, mixing, sharding, packing and language-model scores on small rows."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import sys
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stewardry.llm import hashing, langid, mixing, packing, quality, registered, scoring, sharding
from stewardry.llm.eliasfano import EliasFano
from stewardry.llm.trie import TrieShard
from stewardry.llm.tokens import WordIds

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, kept string, shard int, _tokens int"
ODD = [
    (1, None, "en", "a"), (2, "", None, "a"), (3, " \n\t ", "de", None), (4, "One two three four", "en", "b"),
    (4, "One two three four", "en", "b"), (5, "one TWO three four", "en", "b"), (6, "word " * 30_000, "fr", "a"),
    (None, "no id at all", None, None), (7, "12 + 34 = 46 !!", "en", "b"), (8, "Ünïcode ñandú   łódź ΑΣΣ 漢字", "es", "a"),
    (9, "a|b%%%c@d.org Copyright", "en", "a"), (10, "x" * 20_000, "en", "b"),
]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame([(i, t, g, s, 0, "x", "y", 3, 4) for i, t, g, s in ODD], SCHEMA)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_token_hashes_tell_tokens_apart():
    texts = pa.array([t for _, t, *_ in ODD])
    for chunk in (hashing.CHUNK, 16):
        names, seen = {}, {}
        for lo, hi, found, begins in hashing.TokenHasher(hashing.WORDS, chunk).of_texts(texts):
            for i in range(lo, hi):
                words = words_of(texts[i].as_py())
                mine = found[begins[i - lo]:begins[i - lo + 1]].tolist()
                assert len(words) == len(mine)
                for w, h in zip(words, mine, strict=True):
                    assert names.setdefault(w, h) == h and seen.setdefault(h, w) == w


def brute_shards(rows, shards):
    """The same by plain sorting; rows of (stratum, key, doc_id, crc, size)."""
    null_first = lambda v: (v is not None, v or 0)
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    ranked = []
    for group in by.values():
        group.sort(key=lambda r: (r[1] % 2**64, null_first(r[2]), r[3], r[4]))
        ranked += [((k + 0.5) / len(group), r) for k, r in enumerate(group)]
    ranked.sort(key=lambda x: (x[0], x[1][1], null_first(x[1][2]), x[1][3], x[1][4], x[1][0]))
    return sorted(((r[2], r[3], p * shards // len(ranked)) for p, (_, r) in enumerate(ranked)), key=repr)


@pytest.mark.parametrize("per_bucket", [3, 8192])
def test_sharding_against_plain_sorting(spark, odd, documents, per_bucket):
    for docs in (odd, documents):
        text = F.coalesce("text", F.lit(""))
        rows = docs.select("doc_id", F.col("source").alias("_s"), F.crc32(text.cast("binary")).alias("crc"), (F.octet_length(text) + 1).alias("size"))
        got = sharding.interleaved(rows, F.col("_s"), ["doc_id", "crc", "size"], 16, 17, per_bucket).collect()
        keyed = rows.select(F.coalesce(F.concat(F.lit("="), "_s"), F.lit("")), F.xxhash64(F.lit(17), "doc_id"), "doc_id", "crc", "size")
        assert sorted(((r["doc_id"], r["crc"], r["shard"]) for r in got), key=repr) == brute_shards([tuple(r) for r in keyed.collect()], 16)
        slots = defaultdict(list)
        for r in got:
            slots[r["shard"]].append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        sizes = [len(slots[k]) for k in range(16)]
        assert max(sizes) - min(sizes) <= 1


def test_shards_match_the_mixture(documents):
    out = sharding.sharded_documents(documents, 4).join(documents.select("doc_id", "source"), "doc_id")
    counts = out.groupBy("source").pivot("shard", [0, 1, 2, 3]).count().na.fill(0).collect()
    assert all(max(r[1:]) - min(r[1:]) <= 2 for r in counts)


def test_sharding_of_nothing(empty):
    assert sharding.sharded_documents(empty).collect() == []


def brute_mix(rows, rate, powers, sweeps):
    def topic(t):
        if t is None or t.strip(" ") == "":
            return "empty"
        for kind, marks in (("legal", ("Copyright", "License")), ("contact", ("@",)), ("table", (" | ",)), ("noise", ("!!", "%%%"))):
            if any(m in t for m in marks):
                return kind
        return "prose"

    cells = Counter()
    for _, t, g, s in rows:
        cells[s, g, topic(t)] += len(words_of(t))
    total = sum(cells.values())
    targets = []
    for k, name in enumerate(("source", "lang", "topic")):
        held = Counter()
        for c, n in cells.items():
            held[c[k]] += n
        share = {v: (n / total) ** powers[name] if n else 0.0 for v, n in held.items()}
        targets.append({v: rate * total * x / sum(share.values()) for v, x in share.items()})
    weight = {c: n * rate for c, n in cells.items()}
    for _ in range(sweeps):
        for k in range(3):
            held = Counter()
            for c, w in weight.items():
                held[c[k]] += w
            weight = {c: min(cells[c], w * targets[k][c[k]] / held[c[k]]) if held[c[k]] > 0 else 0.0 for c, w in weight.items()}
    out = []
    for i, t, g, s in rows:
        c = s, g, topic(t)
        p = weight[c] / cells[c] if words_of(t) else 1.0
        u = int(hashlib.md5(f"{mixing.SEED}:{'null' if i is None else i}".encode()).hexdigest()[:8], 16) / 2**32
        out.append((i, round(p, 9), u < p))
    return sorted(out, key=repr)


def test_mixing_against_plain_raking(spark, odd, documents):
    for docs in (odd, documents):
        rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs.collect()]
        got = mixing.calibrated(docs).withColumn("u", mixing.uniform_of(F.col("doc_id"))).collect()
        mine = sorted(((r["doc_id"], round(r["probability"], 9), r["u"] < r["probability"]) for r in got), key=repr)
        assert mine == brute_mix(rows, mixing.RATE, mixing.POWERS, mixing.SWEEPS)
        kept = mixing.mixed(docs)
        assert kept.columns == docs.columns and kept.count() == sum(k for *_, k in mine)


def test_raking_meets_its_targets(documents):
    rows = mixing.calibrated(documents, rate=0.3, sweeps=30).collect()
    total = sum(r["_tokens"] for r in rows)
    held, tokens = Counter(), Counter()
    for r in rows:
        held[r["_lang"]] += r["_tokens"] * r["probability"]
        tokens[r["_lang"]] += r["_tokens"]
    share = {v: (n / total) ** mixing.POWERS["lang"] for v, n in tokens.items()}
    for v in held:
        assert held[v] == pytest.approx(0.3 * total * share[v] / sum(share.values()), rel=0.01)


def test_mixing_of_nothing(empty):
    assert mixing.mixed(empty).collect() == []


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))


def test_word_ids_are_the_tokenizers(tokenizer, documents):
    import public_tokenizers

    own = WordIds(public_tokenizers.path(packing.TOKENIZER), kept=50)
    texts = [t or "" for _, t, *_ in ODD] + [r["text"] or "" for r in documents.limit(60).collect()]
    texts += ["it's we'll  don'T", "<|endoftext|>a<|startoftext|> b", "İstanbul ΟΔΟΣ é ﬁ ½ ④ x y", "́a \U0001f600‍!", "don’t 3.14"]
    for text in texts:
        assert own.of_text(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_kept_words_are_bounded_by_bytes(tokenizer):
    import public_tokenizers

    limit = 1 << 20
    own = WordIds(public_tokenizers.path(packing.TOKENIZER), kept=limit)
    rng = np.random.default_rng(5)
    for k in range(60):
        unspaced = "".join(map(chr, rng.integers(0x4E00, 0x9000, 3000)))
        letters = "".join(map(chr, rng.integers(97, 123, 3000)))
        words = " ".join(f"{letters[i:i + 7]}{k}" for i in range(0, 2900, 7))
        for text in (unspaced, letters, words):
            assert own.of_text(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        stores = (own, own._pieces)
        assert sum(sys.getsizeof(a) + sys.getsizeof(b) for s in stores for a, b in s.items()) <= own.held <= limit
        assert max((len(w) for s in stores for w in s), default=0) <= 40


def test_packing_keeps_all_ids(odd, documents, tokenizer):
    for docs, rows in ((odd, 4), (documents, 40)):
        out = packing.packed(docs, rows_per_partition=rows).collect()
        ids = Counter()
        for r in docs.collect():
            whole = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1]
            for k, start in enumerate(range(0, len(whole), 4096)):
                part = whole[start:start + 4096]
                ids[r["doc_id"], k, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
        assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == ids
        bins = defaultdict(list)
        for r in out:
            bins[r["sequence_id"]].append((r["offset"], r["length"]))
        for held in bins.values():
            held.sort()
            assert [o for o, _ in held] == [0, *itertools.accumulate(n for _, n in held)][:-1]
            assert sum(n for _, n in held) <= 4096
        lengths = np.array([r["length"] for r in out])
        assert packing.bin_bound(lengths, 4096) <= len(bins) <= packing.bin_bound(lengths, 4096) + 1


def least_bins(lengths, capacity):
    """By trying: every length into every open bin."""
    best = len(lengths)

    def place(k, room):
        nonlocal best
        if len(room) >= best:
            return
        if k == len(lengths):
            best = len(room)
            return
        for i in {r: i for i, r in enumerate(room) if r >= lengths[k]}.values():
            place(k + 1, [*room[:i], room[i] - lengths[k], *room[i + 1:]])
        place(k + 1, [*room, capacity - lengths[k]])

    place(0, [])
    return best


def test_bounds_hold_against_trying_all():
    rng = np.random.default_rng(3)
    sharp = 0
    for _ in range(60):
        lengths = np.sort(rng.integers(1, 21, rng.integers(1, 9)))[::-1]
        least, bound = least_bins(lengths.tolist(), 20), packing.bin_bound(lengths, 20)
        bins = len(packing.best_fit(lengths, 20)[2])
        assert bound <= least <= bins
        sharp += bound == bins
    assert sharp > 40


def test_packing_of_nothing(empty):
    assert packing.packed(empty).collect() == []


def test_language_of_held_out_documents(documents):
    net = langid.trained(langid.learnable(documents))
    rows = langid.with_language(documents, net).select("doc_id", "lang", "lang_pred", "score", langid.held_out(F.col("doc_id")).alias("h")).collect()
    unseen = [r for r in rows if r["h"]]
    assert np.mean([r["lang"] == r["lang_pred"] for r in unseen]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_documents(odd, documents, empty):
    net = langid.trained(langid.learnable(documents))
    rows = {r["doc_id"]: r for r in langid.with_language(odd, net).collect()}
    for k in (1, 2, 3, 7):
        assert (rows[k]["lang_pred"], rows[k]["score"]) == (langid.UNKNOWN, 0.0) or k == 7
    assert rows[7]["lang_pred"] == langid.UNKNOWN
    assert rows[10]["lang_pred"] in net.languages
    assert langid.with_language(odd, None).where("lang_pred <> 'und'").isEmpty()
    assert langid.identified(empty).collect() == []
    kept = langid.in_known_language(documents)
    assert kept.columns == documents.columns and kept.count() >= 0.95 * documents.count()
    assert langid.in_known_language(odd).columns == odd.columns


def test_long_texts_are_windowed_alike(documents):
    net = langid.trained(langid.learnable(documents))
    part = " ".join(r["text"] for r in documents.where("lang = 'fr' AND text IS NOT NULL").collect()) + " "
    text = part * (4 * langid.CHUNK // len(part.encode()) + 2)
    data = np.frombuffer(text.encode(), np.uint8)
    assert len(data) > 4 * langid.CHUNK
    windows, covered = langid.windows_of(data)
    want = (net.probabilities(windows) * covered[:, None]).sum(0) / covered.sum()
    (chosen, short), scores = net.predict(pa.array([text, part]))
    assert (chosen, short) == ("fr", "fr") and scores[0] == pytest.approx(float(want.max()), abs=1e-5)


def test_prediction_equals_plain_filters(documents):
    """Every window of some whole texts, byte by byte and filter by filter."""
    net = langid.trained(langid.learnable(documents))
    texts = [r["text"] for r in documents.where("length(text) BETWEEN 200 AND 1500").limit(6).collect()] + ["Ñandú łódź 漢字", "a", "x" * 700]
    names, scores = net.predict(pa.array(texts))
    for text, name, score in zip(texts, names, scores, strict=True):
        data = [b + 32 if 65 <= b <= 90 else b for b in text.encode()]
        mean = np.zeros(len(net.languages))
        for start in range(0, len(data), 253):
            window = (data[start:start + 256] + [0] * 256)[:256]
            pooled = []
            for weights in net.filters:
                places = range(256 - len(weights) + 1)
                pooled += [max(sum(weights[j][window[p + j]][f] for j in range(len(weights))) for p in places) for f in range(langid.FILTERS)]
            raw = np.maximum(np.array(pooled) + net.bias, 0) @ net.top + net.top_bias
            e = np.exp(raw - raw.max())
            mean += e / e.sum() * min(253, len(data) - start)
        mean /= len(data)
        assert name == net.languages[int(mean.argmax())] and score == pytest.approx(mean.max(), abs=1e-4)


def test_every_language_is_learned(spark):
    rows = [(i, f"{chr(0x400 + i % 300)}{chr(0x3041 + i % 80)} word{i % 300} " * 20, f"l{i % 300:03}") for i in range(900)]
    docs = spark.createDataFrame(rows + [(10_000 + i, "common words of it", "common") for i in range(3000)], "doc_id long, text string, lang string")
    assert len(langid.trained(docs, per_language=3).languages) == 301
    few = langid.trained(docs, sample=301)
    assert len(few.languages) == 301


def test_scoring_tables_equal_the_filters(documents):
    net = langid.ByteConvNet(["a", "b"])
    net.tables()
    windows = np.random.default_rng(0).integers(0, langid.SYMBOLS, (70, langid.WINDOW)).astype(np.uint8)
    pooled, _ = net._responses(windows)
    want = np.maximum(pooled + net.bias, 0) @ net.top + net.top_bias
    want = np.exp(want - want.max(1, keepdims=True))
    np.testing.assert_allclose(net.probabilities(windows), want / want.sum(1, keepdims=True), atol=1e-5)


def test_quality_tells_good_from_bad(spark, documents, labels):
    rows = quality.scored(documents, labels).join(labels, "doc_id").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1 and r["toxic"] == 0]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert np.mean(good) >= 0.95 and np.mean(bad) <= 0.2


def test_quality_against_dictionaries(spark, documents, labels):
    """Ratio, weight, noise and the kept set, counted with dictionaries."""
    hasher = hashing.TokenHasher(hashing.WORDS_AND_MARKS)
    marks = re.escape("".join(chr(b) for b in range(128) if hashing.WORDS_AND_MARKS[b] == 2))
    split = re.compile(rf"[{marks}]+|[^{marks}\x20\x09-\x0D]+")
    number = {}

    def grams(text):
        tokens = [t.translate({c: c + 32 for c in range(65, 91)}) for t in split.findall(text or "")]
        for t in tokens:
            if t not in number:
                number[t] = int(next(hasher.of_texts(pa.array([t])))[2][0]) % (quality.BUCKETS - 1) + 1
        return [number[t] for t in tokens] + [0] * sum(a == b for a, b in itertools.pairwise(tokens))

    docs = {r["doc_id"]: grams(r["text"]) for r in documents.collect()}
    good = {r["doc_id"] for r in labels.collect() if r["quality"] == 1 and r["toxic"] == 0} & set(docs)
    raw, target = Counter(g for d in docs.values() for g in d), Counter(g for i in good for g in docs[i])
    share = sum(target.values()) / sum(raw.values())
    ratio = {g: math.log((target[g] + quality.SHRINK) / (n * share + quality.SHRINK)) for g, n in raw.items()}
    weight = {i: sum(ratio[g] for g in d) for i, d in docs.items()}
    cut = sorted(weight[i] for i in good)[math.ceil(quality.TAIL * len(good)) - 1]
    noise = {r["doc_id"]: r["g"] for r in documents.select("doc_id", quality.gumbel(F.col("doc_id")).alias("g")).collect()}
    score = {i: w + quality.TEMPERATURE * noise[i] for i, w in weight.items()}
    k = sum(w >= cut - 1e-6 for w in weight.values())
    least = sorted(score.values(), reverse=True)[k - 1]
    rows = quality.scored(documents, labels).collect()
    assert {r["doc_id"] for r in rows if r["kept"]} == {i for i, v in score.items() if v >= least} and 0 < k < len(docs)
    for r in rows:
        assert r["log_weight"] == pytest.approx(weight[r["doc_id"]], abs=2e-3)
    assert np.mean([-0.8 < g < 2 for g in noise.values()]) > 0.7


def test_quality_of_odd_documents(spark, odd, empty, labels):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = quality.resampled(odd, none)
    assert out.count() == len(ODD) and out.where("log_weight <> 0").isEmpty() and out.where("NOT kept").isEmpty()
    assert quality.of_quality(odd, labels).columns == odd.columns
    some = spark.createDataFrame([(4, 1, 0), (4, 1, 0), (6, 0, 0), (None, 1, 0), (9, None, 1)], "doc_id long, quality int, toxic int")
    assert quality.resampled(odd, some).count() == len(ODD)
    assert quality.scored(empty, labels).collect() == []


def test_kth_largest(spark, monkeypatch):
    monkeypatch.setattr(quality, "SORTED", 3)
    monkeypatch.setattr(quality, "CELLS", 7)
    values = [float(v) for v in np.random.default_rng(2).integers(-50, 50, 200)] + [1e9, -1e9]
    scores = spark.createDataFrame([(v,) for v in values], "score double")
    for k in (1, 2, 3, 100, 150, 201, 202):
        assert quality.kth_largest(scores, k) == sorted(values, reverse=True)[k - 1]
    assert quality.kth_largest(scores, 0) is None


def brute_scores(docs, order):
    """The same model with dictionaries, one shard, nothing quantised."""
    end = object()
    tokens = [(i, [*words_of(t), end]) for i, t in docs]
    train = [w for i, w in tokens if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    counts = Counter(w for t in train for w in t)
    total, size, once = sum(counts.values()), len(counts), max(1, sum(c == 1 for c in counts.values()))
    grams = {k: Counter(tuple(t[j:j + k]) for t in train for j in range(len(t) - k + 1)) for k in range(2, order + 1)}
    discount, contexts = {}, {}
    for k, g in grams.items():
        n1, n2 = sum(c == 1 for c in g.values()), sum(c == 2 for c in g.values())
        discount[k] = min(0.95, n1 / (n1 + 2 * n2)) if n1 else 0.5
        contexts[k] = defaultdict(lambda: [0, 0])
        for gram, c in g.items():
            contexts[k][gram[:-1]][0] += c
            contexts[k][gram[:-1]][1] += 1
    out = []
    for i, t in tokens:
        score = 0.0
        for j, w in enumerate(t):
            p = (counts[w] + once / (size + 1)) / (total + once)
            for k in range(2, order + 1):
                context = tuple(t[j - k + 1:j])
                if j - k + 1 >= 0 and context in contexts[k]:
                    n, kinds = contexts[k][context]
                    p = max(grams[k][*context, w] - discount[k], 0) / n + discount[k] * kinds / n * p
            score += math.log10(p)
        base = sum(math.log10((counts[w] + 1) / (total + size + 1)) for w in t)
        out.append((i, len(t), sum(counts[w] > 0 for w in t), total, base, score))
    return sorted(out, key=repr)


@pytest.mark.parametrize("order", [2, 3])
def test_scores_against_dictionaries(odd, documents, order):
    for docs in (odd, documents.limit(120)):
        got = sorted((tuple(r)[:1] + tuple(r)[2:] for r in scoring.scored(docs, order).collect()), key=repr)
        want = brute_scores([(r["doc_id"], r["text"]) for r in docs.collect()], order)
        assert [g[:4] for g in got] == [w[:4] for w in want]
        for g, w in zip(got, want, strict=True):
            assert g[4] == pytest.approx(w[4], abs=1e-6)
            assert g[5] == pytest.approx(w[5], abs=3e-4 * g[1] + 1e-6)


def test_scores_hold_with_many_files(documents):
    one = {r["doc_id"]: r for r in scoring.scored(documents).collect()}
    many = {r["doc_id"]: r for r in scoring.scored(documents, rows_per_file=4000).collect()}
    for k, r in one.items():
        assert (r["n_known"], r["train_tokens"]) == (many[k]["n_known"], many[k]["train_tokens"])
        assert r["base_score"] == pytest.approx(many[k]["base_score"])
        assert r["score"] == pytest.approx(many[k]["score"], rel=0.02)
    unseen = [r for r in one.values() if r["held_out"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


def test_scores_do_not_depend_on_the_files(documents):
    """One discount for each order: the same text scores alike however many files there are."""
    runs = [{r["doc_id"]: r["score"] for r in scoring.scored(documents, rows_per_file=n).collect()} for n in (10**7, 4000, 900)]
    for k, score in runs[0].items():
        assert all(r[k] == pytest.approx(score, abs=1e-6) for r in runs[1:])


@pytest.mark.parametrize("seed", range(4))
def test_elias_fano_answers_all_questions(seed):
    rng = np.random.default_rng(seed)
    for n, top in ((1, 5), (3, 2**63), (700, 900), (5000, 10**6), (5000, 40), (3000, 2**62), (2000, 64)):
        values = np.sort(rng.integers(0, top, n).astype(np.uint64))
        if n == 5000:
            values[1000:3000] = values[1000]
            values = np.sort(values)
        ef = EliasFano.from_parts(EliasFano.of(values).parts())
        k = rng.permutation(n)
        assert np.array_equal(ef.at(k), values[k])
        a, b = ef.at_and_next(k[k < n - 1])
        assert np.array_equal(a, values[k[k < n - 1]]) and np.array_equal(b, values[k[k < n - 1] + 1])
        asked = np.concatenate([values, values + np.uint64(1), rng.integers(0, top, 500).astype(np.uint64), np.array([0, 2**64 - 1], np.uint64)])
        place, equal = ef.successor(asked)
        want = np.searchsorted(values, asked, side="left")
        assert np.array_equal(place, want)
        assert np.array_equal(equal, (want < n) & (values[np.minimum(want, n - 1)] == asked))


def test_scores_of_nothing(empty, odd):
    assert scoring.scored(empty).collect() == []
    assert scoring.scored(odd.where("doc_id = 6")).count() == 1


def test_the_query_scores_with_three_words(spark, documents):
    """op6 as registered is the model of order 3, also when tasks hand on counts piece by piece."""
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    want = {w[0]: w[5] for w in brute_scores(rows, 3)}
    got = {r["doc_id"]: (r["score"], r["n_tokens"]) for r in registered.op6_lm_scoring(spark, SF).collect()}
    assert got.keys() == want.keys()
    assert all(got[i][0] == pytest.approx(want[i], abs=3e-4 * got[i][1] + 1e-6) for i in want)


def test_counts_survive_their_blobs_and_add_up():
    rng = np.random.default_rng(3)
    held, brute = scoring._Counts(50), Counter()
    for size in (1, 40, 300, 7):
        context, word = rng.integers(0, 9, size).astype(np.uint64) << np.uint64(61), rng.integers(0, 5, size)
        brute.update(zip(context.tolist(), word.tolist(), strict=True))
        run = scoring._combined([[context, word, np.ones(size, np.int64)]])
        for a, b in zip(run, scoring._of_blob(scoring._blob(*run)), strict=True):
            assert a.tolist() == b.tolist()
        held.add(run)
    context, word, n = (x.tolist() for x in held.combine())
    assert list(zip(context, word, strict=True)) == sorted(brute) and n == [brute[k] for k in sorted(brute)]


def test_counts_are_combined_in_little_memory():
    rng = np.random.default_rng(4)
    runs = []
    for rows in (900_000, 400_000, 200_000):
        key = np.unique(rng.integers(0, 1 << 22, rows))
        runs.append([(key >> 4).astype(np.uint64) << np.uint64(33), key & 15, np.ones(len(key), np.int64)])
    rows = sum(len(r[0]) for r in runs)
    tracemalloc.start()
    context, word, n = scoring._combined(runs)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.6 * 24 * rows
    key, counts = np.unique(np.concatenate([(r[0] >> np.uint64(29)).astype(np.int64) | r[1] for r in runs]), return_counts=True)
    assert np.array_equal(key, (context >> np.uint64(29)).astype(np.int64) | word) and np.array_equal(counts, n)


class _AllWords:
    """Stands for a model whose vocabulary is a range of numbers by hash."""

    size = 1 << 15

    def open_vocabulary(self):
        return self

    def look_up(self, hashes):
        return (hashes >> np.uint64(64 - 15)).astype(np.int64), np.ones(len(hashes), np.int64)


class _Batches:
    """Stands for a table that is gone through here and not in a worker."""

    def select(self, *_):
        return self

    def mapInArrow(self, count, _):
        return count


def test_counting_tasks_take_little_memory_and_hand_on_all_counts():
    """4,500,000 n-grams, nearly all of them different."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"{w:05d}" for w in rng.integers(0, 30_000, 3000)) for _ in range(1500)]
    count = scoring.ngram_counts(_Batches(), _AllWords(), 3, 5)
    tracemalloc.start()
    blobs = [(b.column(0)[0].as_py(), b.column(1)[0].as_py()) for b in count(iter([pa.record_batch([pa.array(texts)], ["text"])]))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6 + sum(len(b) for _, b in blobs)
    assert {k for k, _ in blobs} == set(range(5))
    assert sum(int(scoring._of_blob(b)[2].sum()) for _, b in blobs) == 1500 * (3001 - 2)


@pytest.mark.parametrize("size", [1, 2, 37, 64, 65])
def test_contexts_have_numbers_of_their_own_in_their_shards_range(size):
    first, second = (x.ravel() for x in np.meshgrid(np.arange(size), np.arange(size)))
    for words in (1, 2):
        contexts = scoring.Contexts(size, words, 3)
        numbers = np.sort(contexts.of([first, second][:words]))
        assert len(np.unique(numbers)) == size ** words and int(numbers.max()) < 1 << contexts.bits
        edges = contexts.edges(numbers)
        assert edges[0] == 0 and edges[-1] == len(numbers) and (np.diff(edges) >= 0).all()
        if size > 30:
            assert np.diff(edges).max() < 1.5 * len(numbers) / 3


def test_words_after_frequent_contexts_are_found_at_once(monkeypatch):
    """A context with most of all continuations is no heap to be searched step by step."""
    rng, size = np.random.default_rng(6), 200_000
    context = np.concatenate([np.full(20_000, 700), np.repeat(np.arange(2000) + 1000, 3)]).astype(np.uint64)
    word = np.concatenate([np.sort(rng.choice(size, 20_000, replace=False)), *(np.sort(rng.choice(size, 3, replace=False)) for _ in range(2000))])
    n = rng.integers(1, 9, len(word))
    trie, far = TrieShard.of(context, word, n, 0.5, size), []
    select, lows = EliasFano._select, []
    monkeypatch.setattr(EliasFano, "_select", lambda self, k, zeros: (far.append(len(k) * zeros), select(self, k, zeros))[1])
    read = EliasFano._lows
    monkeypatch.setattr(EliasFano, "_lows", lambda self, at: (lows.append(len(at)), read(self, at))[1])
    other = rng.integers(0, size, len(word))
    brute = dict(zip(zip(context.tolist(), word.tolist(), strict=True), n.tolist(), strict=True))
    totals = Counter()
    for (c, _), k in brute.items():
        totals[c] += k
    for asked in (word, other):
        far.clear(), lows.clear()
        given, _ = trie.look_up(context, asked)
        want = [max(0.0, brute.get((c, w), 0) - 0.5) / totals[c] for c, w in zip(context.tolist(), asked.tolist(), strict=True)]
        assert given == pytest.approx(np.array(want), rel=1e-3)
        assert sum(far) < 0.01 * len(word) and sum(lows) < 5 * len(word)


def test_draws_are_in_proportion_to_the_weights(spark):
    """The score is the log weight and whole Gumbel noise: one of two is drawn first by its share."""
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, math.log(3.0)).otherwise(0.0).alias("log_weight"))
    score = {r["doc_id"]: r["s"] for r in rows.select("doc_id", quality._score().alias("s")).collect()}
    first = np.mean([score[i] > score[i + 1] for i in range(0, 20_000, 2)])
    assert first == pytest.approx(0.75, abs=0.02)


def test_pairs_against_dictionaries(spark, documents, labels):
    """The weights of op4: words, marks, "the same again" and all pairs of neighbours, counted with dictionaries."""
    hasher = hashing.TokenHasher(hashing.WORDS_AND_MARKS)
    marks = re.escape("".join(chr(b) for b in range(128) if hashing.WORDS_AND_MARKS[b] == 2))
    split = re.compile(rf"[{marks}]+|[^{marks}\x20\x09-\x0D]+")
    hashes = {}

    def hash_of(token):
        if token not in hashes:
            hashes[token] = int(next(hasher.of_texts(pa.array([token])))[2][0])
        return hashes[token]

    def pair(a, b):
        return int(hashing.mixed(np.array([(3 * a + b) % (1 << 64)], np.uint64))[0]) % quality.PAIRS

    def grams(text):
        found = [hash_of(t.translate({c: c + 32 for c in range(65, 91)})) for t in split.findall(text or "")]
        words = [h % (quality.BUCKETS - 1) + 1 for h in found] + [0] * sum(a == b for a, b in itertools.pairwise(found))
        return words, [pair(a, b) for a, b in itertools.pairwise(found)]

    docs = {r["doc_id"]: grams(r["text"]) for r in documents.collect()}
    good = {r["doc_id"] for r in labels.collect() if r["quality"] == 1 and r["toxic"] == 0} & set(docs)
    weight = Counter()
    for kind, shrink in ((0, quality.SHRINK), (1, quality.PAIR_SHRINK)):
        raw, target = Counter(g for d in docs.values() for g in d[kind]), Counter(g for i in good for g in docs[i][kind])
        share = sum(target.values()) / sum(raw.values())
        for i, d in docs.items():
            weight[i] += sum(math.log((target[g] + shrink) / (raw[g] * share + shrink)) for g in d[kind])
    rows = registered.op4_quality_classifier(spark, SF).collect()
    assert len(rows) == len(docs) and {r["doc_id"] for r in rows} == set(docs)
    for r in rows:
        assert r["log_weight"] == pytest.approx(weight[r["doc_id"]], abs=2e-3, rel=1e-5)


def test_pairs_stay_within_a_text():
    hasher = hashing.TokenHasher(hashing.WORDS_AND_MARKS)
    (lo, hi, grams, text), = quality.grams_of(pa.array(["a b c", None, "d", "c b a", "a b"]), hasher, pairs=True)
    by = [sorted(grams[(text == i) & (grams >= quality.BUCKETS)].tolist()) for i in range(lo, hi)]
    assert [len(b) for b in by] == [2, 0, 0, 2, 1]
    assert by[4][0] in by[0] and not set(by[0]) & set(by[3])
    assert [int((grams[text == i] < quality.BUCKETS).sum()) for i in range(lo, hi)] == [3, 0, 1, 3, 2]
