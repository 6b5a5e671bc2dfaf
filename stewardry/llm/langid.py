"""Language identification by a byte convolutional network.

A text's UTF-8 bytes are folded to 64 symbols and cut into windows of fixed length that
overlap by one filter width less one. Filters of several widths slide over a window, each
filter's largest response is kept (max pooling), and a softmax layer on top gives the
language. The network is trained in numpy on windows of a bounded sample of labelled
texts; every window of every text is scored, and a text's answer is the mean over its
windows, weighted by their bytes.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stewardry.llm.columns import set_aside

SYMBOLS = 256
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
#: Labelled documents to learn from: about so many per language, and at most so many in all.
PER_LANGUAGE, SAMPLE = 400, 4000
#: Windows taken from a document of the sample, evenly spaced.
WINDOWS_EACH = 8
STEPS, BATCH, RATE = 500, 96, 0.01
#: Bytes of text that are scored at once.
CHUNK = 1 << 18
UNKNOWN = "und"


def symbol_table() -> np.ndarray:
    """byte -> symbol: the byte itself, A-Z as a-z. Every byte has its own weights, so scripts
    that share lead bytes are told apart by those that follow."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("A"):ord("Z") + 1] += 32
    return table


_TABLE = symbol_table()
_STRIDE = WINDOW - max(WIDTHS) + 1


def windows_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All windows of one text's bytes as symbols, padded with 0, and the bytes each covers."""
    n = max(1, -(-len(data) // _STRIDE))
    padded = np.zeros((n - 1) * _STRIDE + WINDOW, np.uint8)
    padded[:len(data)] = _TABLE[data]
    places = np.arange(n)[:, None] * _STRIDE + np.arange(WINDOW)
    covered = np.full(n, _STRIDE, np.int64)
    covered[-1] = len(data) - (n - 1) * _STRIDE
    return padded[places], covered


class ByteConvNet:
    """Filters, biases and the softmax layer, with training and fast scoring."""

    def __init__(self, languages: list[str], seed: int = 5):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.filters = [rng.normal(0, 0.3, (w, SYMBOLS, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.top = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages))).astype(np.float32)
        self.top_bias = np.zeros(len(languages), np.float32)

    def _responses(self, windows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Largest response of each filter and where it lies."""
        best, at = [], []
        for weights in self.filters:
            width = len(weights)
            length = windows.shape[1] - width + 1
            total = weights[0][windows[:, :length]]
            for j in range(1, width):
                total += weights[j][windows[:, j:j + length]]
            place = total.argmax(1)
            at.append(place)
            best.append(np.take_along_axis(total, place[:, None], 1)[:, 0])
        return np.concatenate(best, 1), at

    def train(self, windows: np.ndarray, labels: np.ndarray, steps: int = STEPS, seed: int = 7) -> None:
        """Adam on cross entropy; each batch takes the languages in equal parts."""
        rng = np.random.default_rng(seed)
        groups = [np.flatnonzero(labels == k) for k in range(len(self.languages))]
        parameters = [*self.filters, self.bias, self.top, self.top_bias]
        first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
        for step in range(1, steps + 1):
            kinds = rng.integers(0, len(groups), BATCH)
            rows = np.array([rng.choice(groups[k]) for k in kinds])
            x = windows[rows]
            pooled, at = self._responses(x)
            pooled = pooled + self.bias
            active = np.maximum(pooled, 0)
            error = _softmax(active @ self.top + self.top_bias)
            error[np.arange(BATCH), kinds] -= 1
            error /= BATCH
            back = (error @ self.top.T) * (pooled > 0)
            gradients = []
            for i, weights in enumerate(self.filters):
                g = np.zeros_like(weights)
                part = back[:, i * FILTERS:(i + 1) * FILTERS]
                for j in range(len(weights)):
                    seen = np.take_along_axis(x, at[i] + j, 1)
                    np.add.at(g[j], (seen, np.arange(FILTERS)[None, :]), part)
                gradients.append(g)
            gradients += [back.sum(0), active.T @ error, error.sum(0)]
            for k, (p, g) in enumerate(zip(parameters, gradients, strict=True)):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                p -= RATE * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-7)

    def tables(self) -> None:
        """The filters as tables over pairs of symbols, so that scoring looks up pairs."""
        def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return np.ascontiguousarray((a[:, None, :] + b[None, :, :]).reshape(SYMBOLS * SYMBOLS, FILTERS).T)

        two, three, four = self.filters
        self.pair_tables = [pair(w[0], w[1]) for w in self.filters]
        self.third, self.second_pair = np.ascontiguousarray(three[2].T), pair(four[2], four[3])

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """Softmax of each window."""
        n = len(windows)
        pooled = np.empty((n, len(WIDTHS) * FILTERS), np.float32)
        two, three, four = self.pair_tables
        # as many windows at a time as fit the cache
        for lo in range(0, n, 64):
            s = windows[lo:lo + 64].astype(np.intp)
            p = s[:, :-1] * SYMBOLS + s[:, 1:]
            first, third, second = np.ascontiguousarray(p[:, :-1]), np.ascontiguousarray(s[:, 2:]), np.ascontiguousarray(p[:, 2:])
            short = np.ascontiguousarray(p[:, :-2])
            out = pooled[lo:lo + 64]
            for f in range(FILTERS):
                out[:, f] = two[f].take(p, mode="clip").max(1)
                response = three[f].take(first, mode="clip")
                response += self.third[f].take(third, mode="clip")
                out[:, FILTERS + f] = response.max(1)
                response = four[f].take(short, mode="clip")
                response += self.second_pair[f].take(second, mode="clip")
                out[:, 2 * FILTERS + f] = response.max(1)
        return _softmax(np.maximum(pooled + self.bias, 0) @ self.top + self.top_bias)

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; `und` and 0 for a null or one without letters."""
        names = np.array([*self.languages, UNKNOWN], dtype=object)
        chosen, scores = np.full(len(texts), len(self.languages)), np.zeros(len(texts))
        lettered = pc.fill_null(pc.match_substring_regex(texts, r"\pL"), False).to_numpy(zero_copy_only=False)
        rows, parts, size = [], [], 0

        def flush() -> None:
            if not rows:
                return
            cut = np.cumsum([0, *(len(c) for _, c in parts)])[:-1]
            weights = np.concatenate([c for _, c in parts]).astype(np.float64)
            given = self.probabilities(np.concatenate([w for w, _ in parts])) * weights[:, None]
            mean = np.add.reduceat(given, cut, 0) / np.add.reduceat(weights, cut)[:, None]
            chosen[rows], scores[rows] = mean.argmax(1), mean.max(1)
            rows.clear(), parts.clear()

        for i in np.flatnonzero(lettered):
            data = np.frombuffer(texts[int(i)].as_buffer(), np.uint8)
            if len(data) > 4 * CHUNK:
                flush()
                chosen[i], scores[i] = self._long(data)
                continue
            rows.append(i)
            parts.append(windows_of(data))
            size += len(data)
            if size >= CHUNK:
                flush()
                size = 0
        flush()
        return names[chosen].tolist(), np.clip(scores, 0.0, 1.0)

    def _long(self, data: np.ndarray) -> tuple[int, float]:
        """One very long text, some windows at a time."""
        total, step = np.zeros(len(self.languages)), (CHUNK // _STRIDE) * _STRIDE
        for lo in range(0, len(data), step):
            # what follows is shown to the last window of a part, as it is to any other
            windows, covered = windows_of(data[lo:lo + step + WINDOW - _STRIDE])
            keep = -(-min(step, len(data) - lo) // _STRIDE)
            windows, covered = windows[:keep], np.minimum(covered[:keep], _STRIDE)
            covered[-1] = min(step, len(data) - lo) - (keep - 1) * _STRIDE
            total += (self.probabilities(windows) * covered[:, None]).sum(0)
        total /= len(data)
        return int(total.argmax()), float(total.max())


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def trained(labelled: DataFrame, per_language: int = PER_LANGUAGE, sample: int = SAMPLE) -> ByteConvNet | None:
    """A network fitted to rows `doc_id, text, lang` that may all be learned from.

    About `per_language` documents of each language are taken by a hash of their id, at
    most `sample` in all, of every language one before any has two; they alone come to the
    driver. None if there is nothing to learn.
    """
    known = labelled.where(F.col("lang").isNotNull() & F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    # every language needs a row of its own, so there is room for `sample` of them
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(sample)
    draw = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    # a language of few documents gives all it has
    chosen = known.join(F.broadcast(counts), "lang").where((draw < F.lit(float(per_language)) / F.col("count")) | (F.col("count") <= per_language))
    data = chosen.select(F.xxhash64(F.lit(12), "doc_id").alias("k"), "doc_id", "lang", *_excerpts(F.col("text")))
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("k", "doc_id"))
    rows = data.withColumn("turn", turn).orderBy("turn", "k", "doc_id", "lang").limit(sample).drop("turn", "k").collect()
    if not rows:
        return None
    languages = sorted({r["lang"] for r in rows})
    net = ByteConvNet(languages)
    windows, labels = [], []
    for r in rows:
        for part in {p for p in r[2:] if p}:
            windows.append(windows_of(np.frombuffer(part.encode(), np.uint8))[0][0])
            labels.append(languages.index(r["lang"]))
    order = np.lexsort([*np.array(windows).T[:4], labels])
    net.train(np.array(windows)[order], np.array(labels)[order])
    net.tables()
    return net


def _excerpts(text: Column) -> list[Column]:
    """Evenly spaced excerpts of a sampled text, to learn from."""
    room = F.greatest(F.length(text) - WINDOW, F.lit(0))
    return [F.substr(text, (room * F.lit(k / (WINDOWS_EACH - 1)) + 1).cast("int"), F.lit(WINDOW)).alias(f"p{k}") for k in range(WINDOWS_EACH)]


def with_language(docs: DataFrame, net: ByteConvNet | None) -> DataFrame:
    """`docs` with `lang_pred` and `score`; only the text is looked at.

    A null text or one without any letter is `und` with score 0, and so is everything if
    there is no network. Empty inputs give no rows; other columns pass through, but for
    those of the result's names.
    """
    docs = docs.drop("lang_pred", "score")
    shipped = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(net))
    at, names = docs.columns.index("text"), [*docs.columns, "lang_pred", "score"]
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pickle.loads(shipped.value)
        for batch in batches:
            if model is None:
                named, scores = [UNKNOWN] * len(batch), np.zeros(len(batch))
            else:
                named, scores = model.predict(batch.column(at))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(named, pa.string()), pa.array(scores, pa.float64())], names)

    return docs.mapInArrow(score, schema)


def learnable(docs: DataFrame) -> DataFrame:
    """The documents a prediction may be learned from."""
    return docs.select("doc_id", "text", "lang").where(~held_out(F.col("doc_id")))


def identified(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score."""
    net = trained(learnable(docs))
    out = with_language(docs.select("doc_id", "text"), net)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def in_known_language(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents whose language the network tells with at least this score."""
    rows, restored = set_aside(docs, ("doc_id", "text", "lang"))
    told = with_language(rows, trained(learnable(rows)))
    return restored(told.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)))
