"""How the sources of a language differ in their words.

A translate table turns the bytes of a text into terms in one pass: A-Z become a-z, every
byte that is no letter and no part of a non-ASCII character becomes a blank. `bytes.split`
gives the terms, a `Counter` per document their frequencies; a task adds up sparse counts
per language, source and term before anything is shuffled.

Each language keeps the terms of enough documents. A group (language, source) gives every
kept term a smoothed probability in whole billionths, and two distributions p and q differ
by the sum of floor((p - q)^2 / q) over all kept terms. Sources are compared in pairs of
tiles over blocks of terms, so that a task holds one block of two tiles.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stewardry.llm.groups import runs
from stewardry.session import written

#: Documents of its language that a kept term is in, at least.
LEAST_DOCUMENTS = 3
#: Ranks reported of a group's most telling terms.
TOP_TERMS = 200
#: One in a whole probability.
SCALE = 1_000_000_000
#: Distinct (language, source, term) a task adds up before it hands them on.
HELD_COUNTS = 200_000
#: Terms of a block on average, and sources of a tile.
BLOCK_TERMS, TILE_SOURCES = 2048, 64

COUNTS = "lang string, source string, term string, n long, documents long"


def term_table() -> bytes:
    """byte -> what it becomes: letters in lower case, bytes of other characters unchanged,
    everything else a blank."""
    return bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _taken(counts: dict[tuple, list[int]]) -> pa.RecordBatch:
    keys = list(counts)
    columns = [
        pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
        pa.array([k[2] for k in keys], pa.binary()).cast(pa.string()),
        pa.array([v[0] for v in counts.values()], pa.int64()), pa.array([v[1] for v in counts.values()], pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in COUNTS.split(", ")])


def term_counts(docs: DataFrame, held: int = HELD_COUNTS) -> DataFrame:
    """`lang, source, term, n, documents`, with a row of the null term for every group.

    Null text, language and source are read as empty. A task holds `held` distinct counts
    and one document's terms at most.
    """
    table = term_table()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, list[int]] = {}
        for batch in batches:
            for lang, source, text in zip(*(batch.column(i).to_pylist() for i in (0, 1)), batch.column(2), strict=True):
                counts.setdefault((lang, source, None), [0, 0])[1] += 1
                for term, n in Counter(text.as_buffer().to_pybytes().translate(table).split()).items():
                    have = counts.get((lang, source, term))
                    if have is None:
                        counts[lang, source, term] = [n, 1]
                    else:
                        have[0] += n
                        have[1] += 1
                if len(counts) >= held:
                    yield _taken(counts)
                    counts = {}
        if counts:
            yield _taken(counts)

    read = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    found = read.mapInArrow(count, COUNTS)
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))


def _probability(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + terms)), in exact numbers; 1 + SCALE if there are
    no terms at all, where nothing asks for it."""
    of = F.greatest(total + terms, F.lit(1))
    share = F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)"), of.cast("decimal(20,0)"))
    return F.lit(1).cast("long") + share


def kept_terms(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> tuple[DataFrame, DataFrame]:
    """Counts of kept terms and the groups, both written.

    Counts: `lang, source, term, n, lang_n`. Groups: `lang, source, total` (of kept terms),
    `lang_total, terms` (the number that the language keeps) and `at`, the group's number
    within its language.
    """
    counts = written(term_counts(docs), "term-counts")
    of_term = Window.partitionBy("lang", "term")
    kept = counts.where("term IS NOT NULL").withColumns({
        "lang_n": F.sum("n").over(of_term), "_documents": F.sum("documents").over(of_term)})
    kept = written(kept.where(F.col("_documents") >= least).select("lang", "source", "term", "n", "lang_n"), "kept-terms")

    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    # a term counts for its first source alone
    first = kept.groupBy("lang", "term").agg(F.lit(1).alias("_one")).groupBy("lang").agg(F.count("*").alias("terms"))
    groups = counts.where("term IS NULL").select("lang", "source").join(totals, ["lang", "source"], "left").join(first, "lang", "left")
    of_lang = Window.partitionBy("lang")
    groups = groups.select(
        "lang", "source", F.coalesce("total", F.lit(0)).alias("total"),
        F.coalesce(F.sum("total").over(of_lang), F.lit(0)).alias("lang_total"), F.coalesce("terms", F.lit(0)).alias("terms"),
        (F.row_number().over(of_lang.orderBy("source")) - 1).alias("at"),
    )
    return kept, written(groups, "term-groups")


def telling_terms(kept: DataFrame, groups: DataFrame, ranks: int = TOP_TERMS) -> DataFrame:
    """Per group the terms it uses more than its language does: `lang, source, item, value, rank`."""
    given = kept.join(groups, ["lang", "source"])
    p, q = _probability(F.col("n"), F.col("total"), F.col("terms")), _probability(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    told = given.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    valued = told.select("lang", "source", "item", F.expr("(p - q) * (p - q) DIV q").alias("value"))
    return _ranked(valued).where(F.col("rank") <= ranks)


def _ranked(valued: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return valued.withColumn("rank", F.row_number().over(order))


def _block_distances(rows: pa.Table, tile: int) -> pa.RecordBatch:
    """`lang, at, other, value, seen` of one block of terms and one pair of tiles: for every
    ordered pair of sources the sum over the block's terms that a source of the two tiles
    uses, and the number of these. Rows of the null term hold the groups' p of a term they
    lack."""
    lang, header = rows["lang"][0].as_py(), pc.is_null(rows["term"])
    heads, rest = rows.filter(header), rows.filter(pc.invert(header))
    at, first = np.unique(heads["at"].to_numpy(), return_index=True)
    term = pc.dictionary_encode(rest["term"]).combine_chunks()
    width = len(term.dictionary)
    p = np.repeat(heads["p"].to_numpy()[first][:, None], width, axis=1)
    p[np.searchsorted(at, rest["at"].to_numpy()), term.indices.to_numpy()] = rest["p"].to_numpy()
    of_tile = at // tile
    left, right = np.flatnonzero(of_tile == of_tile[0]), np.flatnonzero(of_tile == of_tile[-1])
    mine, other, value = [], [], []
    for ones, others in ((left, right), (right, left))[:1 if of_tile[0] == of_tile[-1] else 2]:
        for i in ones.tolist():
            d = p[i] - p[others]
            mine.append(np.full(len(others), at[i]))
            other.append(at[others])
            value.append((d * d // p[others]).sum(1))
    mine, other, value = map(np.concatenate, (mine, other, value))
    apart = mine != other
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * int(apart.sum()), pa.string()), *(pa.array(c[apart], pa.int64()) for c in (mine, other, value, np.full(len(mine), width)))],
        ["lang", "at", "other", "value", "seen"])


def source_distances(kept: DataFrame, groups: DataFrame, block_terms: int = BLOCK_TERMS, tile: int = TILE_SOURCES) -> DataFrame:
    """Every ordered pair of sources of a language: `lang, source, item, value, rank`.

    Terms are dealt to blocks by hash and sources to tiles; a task adds up one block of one
    pair of tiles, and the sums of blocks are added up once more.
    """
    sized = groups.withColumns({
        "_blocks": F.greatest(F.ceil(F.col("terms") / block_terms), F.lit(1)), "_tile": F.floor(F.col("at") / tile),
        "_tiles": F.floor((F.max("at").over(Window.partitionBy("lang")) / tile)) + 1})
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_tiles") - 1)).alias("_other")
    pair = (F.least("_tile", "_other").alias("i"), F.greatest("_tile", "_other").alias("j"))
    nothing = _probability(F.lit(0).cast("long"), F.col("total"), F.col("terms"))
    heads = sized.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)).alias("block")).select(
        "lang", "block", "at", F.lit(None).cast("string").alias("term"), nothing.alias("p"), "_tile", other)
    of_terms = kept.join(sized, ["lang", "source"]).select(
        "lang", F.pmod(F.xxhash64("term"), F.col("_blocks")).alias("block"), "at", "term",
        _probability(F.col("n"), F.col("total"), F.col("terms")).alias("p"), "_tile", other)
    rows = heads.unionByName(of_terms).select("lang", "block", *pair, F.col("at").cast("long").alias("at"), "term", "p")
    keys = ["lang", "block", "i", "j"]
    sums = rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
        lambda batches: (_block_distances(rows, tile) for rows in runs(batches, keys)), "lang string, at long, other long, value long, seen long")
    sums = sums.groupBy("lang", "at", "other").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    # the terms that neither tile uses differ by the same each
    named = sized.select("lang", F.col("at").cast("long").alias("at"), "source", "terms", nothing.alias("p"))
    others = named.select("lang", F.col("at").alias("other"), F.col("source").alias("item"), F.col("p").alias("q"))
    unseen = F.expr("value + (terms - seen) * ((p - q) * (p - q) DIV q)").alias("value")
    return _ranked(sums.join(named, ["lang", "at"]).join(others, ["lang", "other"]).select("lang", "source", "item", unseen))


def source_divergence(docs: DataFrame, least: int = LEAST_DOCUMENTS, ranks: int = TOP_TERMS) -> DataFrame:
    """Per group (language, source): lang, source, part, item, value, rank.

    Part `pair`: the other sources of the language, farthest first; part `term`: the terms
    that tell the group from its language, at most `ranks`. Ties go by item in UTF-8 order.
    Null text, language and source count as empty ones; groups without terms are compared
    like others; a language that keeps no term has distances of 0; no documents, no rows.
    Other columns do not matter, and repeated rows count as often as they are there.
    """
    kept, groups = kept_terms(docs, least)
    columns = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return columns(source_distances(kept, groups), "pair").unionByName(columns(telling_terms(kept, groups, ranks), "term"))
