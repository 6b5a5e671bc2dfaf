"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of source, language and topic. The token weights of the cells
are raked: scaled in turn so that their sums per source, per language and per topic meet
the targets, never above the tokens a cell has. A document is then kept with the
probability weight / tokens of its cell, decided by a hash of its id. All of it is
DataFrame work: documents are aggregated to cells once, and the raking is a chain of
window sums over cells.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stewardry.llm.columns import set_aside
from stewardry.session import written

#: Share of all tokens to keep, powers that temper the present shares into targets, and
#: rounds of raking; the parameters of the registered query and of the pipeline.
RATE = 0.75
POWERS = {"source": 0.7, "lang": 0.8, "topic": 0.9}
SWEEPS = 8
SEED = "mix-1"

MARGINS = ("source", "lang", "topic")


def topic_of(text: Column) -> Column:
    """The kind of a text, by marks that need no model: the first that fits."""
    return (
        F.when(text.isNull() | (F.trim(text) == ""), "empty")
        .when(text.contains("Copyright") | text.contains("License"), "legal")
        .when(text.contains("@"), "contact")
        .when(text.contains(" | "), "table")
        .when(text.contains("!!") | text.contains("%%%"), "noise")
        .otherwise("prose")
    )


def words_of(text: Column) -> Column:
    """The number of words between ASCII white space (null: 0), the token weight."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def uniform_of(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the id and the seed alone."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def with_margins(docs: DataFrame) -> DataFrame:
    """`docs` with `_source`, `_lang`, `_topic` (never null) and `_tokens`."""
    known = lambda name: F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit(""))
    return docs.withColumns({
        "_source": known("source"), "_lang": known("lang"), "_topic": topic_of(F.col("text")),
        "_tokens": words_of(F.col("text")),
    })


def tempered_targets(cells: DataFrame, powers: dict[str, float] = POWERS, rate: float = RATE) -> DataFrame:
    """Cells with a target in tokens for each margin: present shares to a power, rescaled.

    A margin's target is rate * all tokens * share^power / sum over its values. A value
    of no tokens has none.
    """
    everything = Window.partitionBy(F.lit(0))
    out = cells.withColumn("_all", F.sum("_tokens").over(everything))
    for name in MARGINS:
        of = Window.partitionBy(f"_{name}")
        total = F.sum("_tokens").over(of).cast("double")
        # each cell carries its part of its value's tempered share, so that the sum over
        # cells is the sum over values
        share = F.when(total > 0, F.pow(total / F.col("_all"), F.lit(powers[name]))).otherwise(F.lit(0.0))
        part = F.when(total > 0, share * F.col("_tokens") / total).otherwise(F.lit(0.0))
        out = out.withColumn("_share", share).withColumn("_part", part)
        out = out.withColumn(f"_target_{name}", F.lit(rate) * F.col("_all") * F.col("_share") / F.sum("_part").over(everything))
    return out.drop("_share", "_part", "_all")


def raked(cells: DataFrame, rate: float = RATE, sweeps: int = SWEEPS) -> DataFrame:
    """Cells with `weight`: tokens to keep, raked to the targets and at most `_tokens`.

    Where the limit and the targets are at odds, the last margin raked is met best and
    the weights stay the closest the rounds reached.
    """
    out = cells.withColumn("weight", F.col("_tokens") * F.lit(rate))
    for _ in range(sweeps):
        for name in MARGINS:
            held = F.sum("weight").over(Window.partitionBy(f"_{name}"))
            out = out.withColumn("_held", held).withColumn("weight", F.when(
                F.col("_held") > 0,
                F.least(F.col("_tokens").cast("double"), F.col("weight") * F.col(f"_target_{name}") / F.col("_held")),
            ).otherwise(F.lit(0.0)))
    return out.drop("_held")


def calibrated(docs: DataFrame, rate: float = RATE, powers: dict[str, float] = POWERS, sweeps: int = SWEEPS) -> DataFrame:
    """`docs` with `_source`, `_lang`, `_topic`, `_tokens` and `probability`.

    Null sources and languages are values of their own. Documents without tokens carry no
    weight: they are kept with probability 1. Repeated rows count each. Other columns are
    passed through, but for those of the result's names.
    """
    marked = with_margins(docs.drop("_source", "_lang", "_topic", "_tokens", "_cell_probability", "probability"))
    cells = marked.groupBy("_source", "_lang", "_topic").agg(F.sum("_tokens").alias("_tokens"))
    cells = raked(tempered_targets(written(cells, "mix-cells"), powers, rate), rate, sweeps)
    cells = written(cells.select(
        "_source", "_lang", "_topic",
        F.when(F.col("_tokens") > 0, F.col("weight") / F.col("_tokens")).otherwise(F.lit(1.0)).alias("_cell_probability"),
    ), "mix-weights")
    joined = marked.join(cells, ["_source", "_lang", "_topic"])
    probability = F.when(F.col("_tokens") > 0, F.col("_cell_probability")).otherwise(F.lit(1.0))
    return joined.withColumn("probability", probability).drop("_cell_probability")


def mixed(docs: DataFrame, rate: float = RATE, powers: dict[str, float] = POWERS, sweeps: int = SWEEPS, seed: str = SEED) -> DataFrame:
    """The sampled documents, columns as they came."""
    rows, restored = set_aside(docs, ("doc_id", "text", "source", "lang"))
    return restored(calibrated(rows, rate, powers, sweeps).where(uniform_of(F.col("doc_id"), seed) < F.col("probability")))


def mixing_sql(source: str, rate: float = RATE, powers: dict[str, float] = POWERS, sweeps: int = SWEEPS, seed: str = SEED) -> str:
    """DuckDB: WITH parts up to `mixed_docs` (doc_id, source, lang, topic, n_tokens, probability, kept) over a relation."""
    tokens = r"len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))"
    names = ", ".join(MARGINS)
    parts = [f"""mix_marked AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || source, '') AS source, coalesce('=' || lang, '') AS lang,
    CASE WHEN text IS NULL OR trim(text, ' ') = '' THEN 'empty'
         WHEN contains(text, 'Copyright') OR contains(text, 'License') THEN 'legal'
         WHEN contains(text, '@') THEN 'contact' WHEN contains(text, ' | ') THEN 'table'
         WHEN contains(text, '!!') OR contains(text, '%%%') THEN 'noise' ELSE 'prose' END AS topic,
    coalesce({tokens}, 0)::BIGINT AS tokens
  FROM {source})""", f"mix_cells AS MATERIALIZED (SELECT {names}, sum(tokens)::BIGINT AS tokens FROM mix_marked GROUP BY {names})"]
    shares = [f"""mix_of_{m} AS MATERIALIZED (SELECT {m}, CASE WHEN sum(tokens) > 0 THEN
  pow(sum(tokens)::DOUBLE / (SELECT sum(tokens) FROM mix_cells), {powers[m]}) ELSE 0 END AS share FROM mix_cells GROUP BY {m})""" for m in MARGINS]
    targets = ", ".join(f"{rate} * (SELECT sum(tokens) FROM mix_cells)::DOUBLE * mix_of_{m}.share / (SELECT sum(share) FROM mix_of_{m}) AS target_{m}" for m in MARGINS)
    joins = " ".join(f"JOIN mix_of_{m} USING ({m})" for m in MARGINS)
    parts += [*shares, f"mix_0 AS MATERIALIZED (SELECT {names}, tokens, {targets}, tokens * {rate}::DOUBLE AS weight FROM mix_cells {joins})"]
    step = 0
    for _ in range(sweeps):
        for m in MARGINS:
            parts.append(f"""mix_{step + 1} AS MATERIALIZED (SELECT * EXCLUDE (weight, held), CASE WHEN held > 0 THEN
  least(tokens::DOUBLE, weight * target_{m} / held) ELSE 0 END AS weight FROM (SELECT *, sum(weight) OVER (PARTITION BY {m}) AS held FROM mix_{step}))""")
            step += 1
    parts.append(f"""mixed_docs AS (
  SELECT doc_id, d.source, d.lang, d.topic, d.tokens AS n_tokens, CASE WHEN d.tokens > 0 THEN weight / c.tokens ELSE 1.0 END AS probability,
    ('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT / 4294967296.0 < CASE WHEN d.tokens > 0 THEN weight / c.tokens ELSE 1.0 END AS kept
  FROM mix_marked d JOIN mix_{step} c ON d.source = c.source AND d.lang = c.lang AND d.topic = c.topic)""")
    return ",\n".join(parts)
