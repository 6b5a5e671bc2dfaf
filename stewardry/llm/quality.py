"""Quality by importance resampling.

Two generative models over hashed n-grams, one of the target documents and one of all raw
documents, give every document an importance weight, the ratio of its probabilities. As
many documents are drawn as have at least the weight that nearly all target documents
have, without replacement and in proportion to their weights, by taking the top k of
log weight + Gumbel noise.

The n-grams are single words and marks (a mark is a run of punctuation), the pair "the same
again" and, with `pairs`, every pair of neighbours. Pairs have hash buckets of their own and are
drawn more towards a ratio of 1: most pairs of a small corpus are new and would only add noise to
a long document's weight.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stewardry.llm.columns import set_aside
from stewardry.llm.hashing import WORDS_AND_MARKS, TokenHasher, mixed
from stewardry.session import written

#: Hash buckets of words and marks, bucket 0 being "the same again", and of pairs behind them.
BUCKETS, PAIRS = 1 << 20, 1 << 20
#: Counts by which a bucket's ratio is drawn towards 1, for words and for pairs.
SHRINK, PAIR_SHRINK = 5.0, 50.0
#: Share of the target documents whose weight may lie below the rest.
TAIL = 0.01
#: Target documents to learn from, at most; drawn by a hash of their id.
SAMPLE = 20_000
#: Scale of the Gumbel noise; 1 samples in exact proportion to the weights.
TEMPERATURE = 1.0
SEED = 29
#: Buckets of a histogram and the rows that are sorted at once, in finding the k-th score.
CELLS, SORTED = 4096, 50_000


def grams_of(texts: pa.Array, hasher: TokenHasher, pairs: bool = False) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(lo, hi, buckets, text of each) for successive ranges of texts, repeats included."""
    for lo, hi, hashes, begins in hasher.of_texts(texts):
        words = (hashes % np.uint64(BUCKETS - 1)).astype(np.int32) + 1
        text = np.repeat(np.arange(hi - lo), np.diff(begins))
        again = np.flatnonzero((hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1]))
        found, of = [words, np.zeros(len(again), np.int32)], [text, text[again]]
        if pairs:
            first = np.flatnonzero(text[1:] == text[:-1])
            both = mixed(hashes[first] * np.uint64(3) + hashes[first + 1])
            found.append((both % np.uint64(PAIRS)).astype(np.int32) + BUCKETS)
            of.append(text[first])
        yield lo, hi, np.concatenate(found), np.concatenate(of)


def bucket_counts(docs: DataFrame, pairs: bool = False) -> DataFrame:
    """bucket, raw, target: n-grams of all rows and of those with `_target`, a row for a bucket."""
    size = BUCKETS + (PAIRS if pairs else 0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = TokenHasher(WORDS_AND_MARKS)
        counts = np.zeros((2, size), np.int64)

        def handed_on() -> pa.RecordBatch:
            used = np.flatnonzero(counts[0])
            out = pa.RecordBatch.from_arrays(
                [pa.array(used.astype(np.int32)), pa.array(counts[0][used]), pa.array(counts[1][used])], ["bucket", "raw", "target"])
            return out

        for batch in batches:
            target = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for lo, hi, grams, text in grams_of(batch.column(0), hasher, pairs):
                counts[0] += np.bincount(grams, minlength=size)
                counts[1] += np.bincount(grams[target[lo:hi][text]], minlength=size)
        yield handed_on()

    parts = docs.select("text", "_target").mapInArrow(count, "bucket int, raw long, target long")
    return parts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame, pairs: bool = False) -> np.ndarray:
    """log P(bucket | target) / P(bucket | raw), drawn towards 0 where counts are small; words
    and pairs each have their own probabilities."""
    rows = counts.toArrow()  # BUCKETS and PAIRS rows at most
    size = BUCKETS + (PAIRS if pairs else 0)
    raw, target = np.zeros(size), np.zeros(size)
    at = rows.column("bucket").to_numpy()
    raw[at], target[at] = rows.column("raw").to_numpy(), rows.column("target").to_numpy()
    ratios = np.zeros(size, np.float32)
    for part, shrink in ((slice(0, BUCKETS), SHRINK), (slice(BUCKETS, size), PAIR_SHRINK)):
        expected = raw[part] * (target[part].sum() / max(1.0, raw[part].sum()))
        ratios[part] = np.log((target[part] + shrink) / (expected + shrink))
    return ratios


def with_weights(docs: DataFrame, ratios: np.ndarray, name: str = "log_weight", pairs: bool = False) -> DataFrame:
    """`docs` with the log importance weight of each text; null and empty texts have 0."""
    shipped = docs.sparkSession.sparkContext.broadcast(ratios)
    at, names = docs.columns.index("text"), [*docs.columns, name]
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, table = TokenHasher(WORDS_AND_MARKS), shipped.value
        for batch in batches:
            weights = np.zeros(len(batch))
            for lo, hi, grams, text in grams_of(batch.column(at), hasher, pairs):
                weights[lo:hi] = np.bincount(text, weights=table[grams], minlength=hi - lo)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(weights, pa.float64())], names)

    return docs.mapInArrow(weigh, schema)


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise that depends on the id and the seed alone."""
    key = F.xxhash64(F.lit(seed), doc_id)
    uniform = (F.shiftrightunsigned(key, 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    return -F.log(-F.log(uniform))


def kth_largest(scores: DataFrame, k: int) -> float | None:
    """The k-th largest `score`; None for k = 0. Exact: the range is narrowed by histograms
    until few rows are left in it, or all rows in it are equal."""
    if k <= 0:
        return None
    low, high = scores.agg(F.min("score"), F.max("score")).first()
    above, within = 0, scores
    while low < high:
        width = (high - low) / CELLS
        cell = F.least(F.lit(CELLS - 1), F.floor((F.col("score") - low) / width)).cast("int")
        cells = sorted(within.groupBy(cell.alias("cell")).agg(F.count("*").alias("n"), F.min("score").alias("low"), F.max("score").alias("high")).collect(), reverse=True)
        for found in cells:
            if above + found["n"] >= k:
                break
            above += found["n"]
        low, high = found["low"], found["high"]
        within = scores.where(F.col("score").between(low, high))
        if found["n"] <= SORTED:
            return within.orderBy(F.desc("score")).limit(k - above).agg(F.min("score")).first()[0]
    return low


def _weighed(docs: DataFrame, labels: DataFrame, pairs: bool) -> tuple[DataFrame, DataFrame, float | None]:
    """Rows with their weight, `doc_id` and weight alone as written, and the least score drawn."""
    good = labels.where((F.col("quality") == 1) & (F.col("toxic") == 0) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    # SAMPLE ids at most, so that texts need not be shuffled to meet them
    target = written(good.orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(SAMPLE), "targets")
    marked = docs.join(F.broadcast(target.withColumn("_target", F.lit(True))), "doc_id", "left").select(
        *(F.col(f"`{c}`") for c in docs.columns), F.coalesce("_target", F.lit(False)).alias("_target"))
    weighed = with_weights(marked, log_ratios(bucket_counts(marked, pairs), pairs), pairs=pairs)
    narrow = written(weighed.select("doc_id", "_target", "log_weight"), "weights")
    cut = narrow.where("_target").agg(F.percentile_approx("log_weight", TAIL, 100_000)).first()[0]
    k = narrow.where(F.col("log_weight") >= F.lit(cut)).count() if cut is not None else narrow.count()
    return weighed, narrow, kth_largest(narrow.select(_score().alias("score")), k)


def _score() -> Column:
    return F.col("log_weight") + F.lit(TEMPERATURE) * gumbel(F.col("doc_id"))


def _drawn(weighed: DataFrame, least: float | None) -> DataFrame:
    kept = F.coalesce(F.col("score") >= F.lit(least).cast("double"), F.lit(False))
    return weighed.withColumn("score", _score()).withColumn("kept", kept).drop("_target")


def resampled(docs: DataFrame, labels: DataFrame, pairs: bool = False) -> DataFrame:
    """Per document: doc_id, log_weight, score, kept; the rest of `docs` is passed through.

    Target are the documents labelled of quality 1 and not toxic (a null is neither), SAMPLE
    of them at most; raw are all documents; without any target, every ratio is 1. With `pairs`,
    pairs of neighbouring words and marks count beside the single ones. The number
    drawn is that of the documents whose log weight reaches the TAIL quantile of the target's.
    Documents of equal score at the cut are kept together. Null and empty texts have log
    weight 0. Repeated ids draw the same noise. Columns of the result's names are replaced.
    """
    weighed, _, least = _weighed(docs.drop("_target", "log_weight", "score", "kept"), labels, pairs)
    return _drawn(weighed, least)


def scored(docs: DataFrame, labels: DataFrame, pairs: bool = False) -> DataFrame:
    """Per document: doc_id, log_weight, score, kept, as in `resampled`."""
    _, narrow, least = _weighed(docs.select("doc_id", "text"), labels, pairs)
    return _drawn(narrow, least)


def of_quality(docs: DataFrame, labels: DataFrame, pairs: bool = False) -> DataFrame:
    """The sampled documents, columns as they came."""
    rows, restored = set_aside(docs, ("doc_id", "text"))
    return restored(resampled(rows, labels, pairs).where("kept"))
