"""Model prompts and answers, as columns. No model is called here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stewardry import vocab
from stewardry.schemas import MEMBERS, RESPONSE, RESPONSE_PERSON


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def model_prompt(
    company: Column | str, text: Column | str, max_chars: int | None = None
) -> Column:
    """The prompt for one company's text; `max_chars` cuts the text for small models
    (`vocab.PROMPT_TEXT_CHARS` is the documented choice)."""
    before, rest = vocab.PROMPT_TEMPLATE.split("{company}")
    between, after = (part.format() for part in rest.split("{text}"))
    content = F.coalesce(_col(text), F.lit(""))
    if max_chars is not None:
        content = F.left(content, F.lit(max_chars))
    return F.concat(
        F.lit(before), F.coalesce(_col(company), F.lit("")), F.lit(between), content, F.lit(after)
    )


def parse_response(response: Column | str) -> Column:
    """`struct<officers, board_members>`; whatever cannot be read is an empty list."""
    parsed = F.from_json(_col(response), RESPONSE)
    nobody = F.array().cast(MEMBERS)
    return F.struct(
        F.coalesce(parsed["officers"], nobody).alias("officers"),
        F.coalesce(parsed["board_members"], nobody).alias("board_members"),
    )


def parse_person_list(response: Column | str) -> Column:
    """`array<struct<name, role>>` of an answer in list form; unreadable -> empty."""
    schema = "array<struct<name:string,role:string>>"
    return F.coalesce(F.from_json(_col(response), schema), F.array().cast(schema))


def flatten_response(answers: DataFrame, response: str = "response") -> DataFrame:
    """One row per person of any category: `name, title, bio`, missing ones ''."""
    others = [c for c in answers.columns if c != response]
    schema = f"map<string,array<{RESPONSE_PERSON.simpleString()}>>"
    categories = answers.select(*others, F.explode(F.from_json(response, schema)).alias("category", "_people"))
    people = categories.select(*others, "category", F.explode("_people").alias("_p"))
    return people.select(
        *others, "category",
        *(F.coalesce(F.col(f"_p.{c}"), F.lit("")).alias(c) for c in ("name", "title", "bio")),
    )


def has_key_positions(officers: Column | str, board_members: Column | str) -> Column:
    """True where the officers include a CEO and the board a chairman."""
    def any_title(members: Column, titles: tuple[str, ...]) -> Column:
        return F.coalesce(
            F.exists(members, lambda m: F.coalesce(F.lower(m["title"]).isin(*titles), F.lit(False))),
            F.lit(False),
        )

    return any_title(_col(officers), vocab.CHIEF_TITLES) & any_title(
        _col(board_members), vocab.CHAIR_TITLES
    )


def local_then_model(local: DataFrame, answers: DataFrame, key: str = "id") -> DataFrame:
    """Both lists per company: local ones where they hold the key positions, else local
    and model ones together.

    `answers` has `key, response`. `data_source` says `local`, or `llm` where the model
    was asked.
    """
    answered = answers.select(key, parse_response("response").alias("_model"))
    nobody = F.array().cast(MEMBERS)
    enough = has_key_positions("officers", "board_members")

    def lists(column: str) -> Column:
        own = F.coalesce(column, nobody)
        other = F.coalesce(F.col("_model")[column], nobody)
        return F.when(enough, own).otherwise(F.array_union(own, other))

    source = F.when(enough | F.col("_model").isNull(), F.lit("local")).otherwise(F.lit("llm"))
    kept = [c for c in local.columns if c not in ("officers", "board_members", "data_source")]
    return local.join(answered, key, "left").select(
        *kept, lists("officers").alias("officers"), lists("board_members").alias("board_members"),
        F.struct(source.alias("officers"), source.alias("board_members")).alias("data_source"),
    )
