"""Text reports: one per page, one per company.

Headings, rules and labels of the reports are fixed values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stewardry.operators.spread import join_hot
from stewardry.session import written

_RULE = "-" * 50
_DOUBLE_RULE = "=" * 50


def json_string(text: Column) -> Column:
    """The text as an ASCII JSON string, characters beyond ASCII as `\\uXXXX`."""
    quoted = F.to_json(F.array(text))
    quoted = F.substr(quoted, F.lit(2), F.length(quoted) - 2)
    escaped = F.array_join(
        F.transform(
            F.regexp_extract_all(quoted, F.lit("(?s)."), F.lit(0)),
            lambda c: F.when(
                c.rlike(r"[^\x00-\x7f]"),
                F.regexp_replace(F.lower(F.hex(F.encode(c, "UTF-16BE"))), "(.{4})", r"\\u$1"),
            ).otherwise(c),
        ),
        "",
    )
    plain = F.when(quoted.rlike(r"[^\x00-\x7f]"), escaped).otherwise(quoted)
    return F.when(text.isNull(), F.lit("null")).otherwise(plain)


def _contact_json(email: Column, phone: Column) -> Column:
    lines = F.concat_ws(
        ",\n",
        F.when(email.isNotNull(), F.concat(F.lit('      "email": '), json_string(email))),
        F.when(phone.isNotNull(), F.concat(F.lit('      "phone": '), json_string(phone))),
    )
    return F.when(lines == "", F.lit("null")).otherwise(
        F.concat(F.lit("{\n"), lines, F.lit("\n    }"))
    )


def person_json(person: Column) -> Column:
    """A person as an item of an indented JSON list."""
    return F.concat(
        F.lit('  {\n    "name": '), json_string(person["name"]),
        F.lit(',\n    "role": '), json_string(person["role"]),
        F.lit(',\n    "contact_info": '), _contact_json(person["email"], person["phone"]),
        F.lit("\n  }"),
    )


def people_json(people: Column) -> Column:
    """A page's list of people as indented JSON."""
    items = F.array_join(F.transform(people, person_json), ",\n")
    return F.when(F.size(people) == 0, F.lit("[]")).otherwise(
        F.concat(F.lit("[\n"), items, F.lit("\n]"))
    )


def _or_none(text: Column | str) -> Column:
    return F.coalesce(text, F.lit("None"))


def page_summary() -> Column:
    """The report of a processed page (columns of `plans.extraction.process_pages`)."""
    def final(title: str, column: str, nobody: str) -> Column:
        people = F.col(column)
        return F.concat(
            F.lit(f"\n\n=== {title} ===\n"),
            F.when(F.size(people) == 0, F.lit(nobody)).otherwise(people_json(people)),
        )

    sections = F.transform(
        "relevant", lambda s: F.concat(F.lit("\n["), s, F.lit(f"]\n{_RULE}\n"), s)
    )
    head = F.concat(
        F.lit("URL: "), _or_none("url"), F.lit("\nTitle: "), _or_none("title"),
        F.lit("\nSource File: "), _or_none("source_file"), F.lit("\n"),
    )
    return F.array_join(
        F.concat(
            F.array(head, F.lit("=== Management Sections ===")),
            sections,
            F.array(
                final("Final Executives List", "executives", "No executives extracted"),
                final("Final Board Members List", "board_members", "No board members extracted"),
            ),
        ),
        "\n",
    )


def render_page_summary(processed: DataFrame) -> DataFrame:
    """`source_file, summary` per page."""
    return processed.select("source_file", page_summary().alias("summary"))


def _person_lines(person: Column) -> Column:
    contact = F.concat_ws(
        "\n",
        F.when(person["email"].isNotNull(), F.concat(F.lit("  email: "), person["email"])),
        F.when(person["phone"].isNotNull(), F.concat(F.lit("  phone: "), person["phone"])),
    )
    return F.concat(
        F.lit("\nName: "), person["name"], F.lit("\nRole: "), person["role"],
        F.when(contact == "", F.lit("")).otherwise(F.concat(F.lit("\nContact Info:\n"), contact)),
    )


def render_company_report(summary: DataFrame, unique: DataFrame) -> DataFrame:
    """The report of each company as `id, company_name, block, place, text`.

    Ordered by `block, place`, the texts of one id joined by line ends are the report. It stays in
    rows so that a company with very many people never has to fit into one of them.
    `summary` is `company_people_summary`, `unique` is `unique_people` by `domain`; it is
    written in between, as marks and entries both need it.
    """
    unique = written(unique, "unique-people")
    nowhere = F.struct(F.lit("").alias("url"), F.lit(-1).alias("seq"))
    lists = (("executive", "Executives/Officers", "Executives", 1), ("board", "Board Members", "Board Members", 2))
    last_places = unique.groupBy("domain").agg(*(
        F.max(F.when(F.col("list") == name, F.col("first_seen"))).alias(f"_last_{name}")
        for name, *_ in lists
    ))
    found = F.col("total_people") > 0
    frame = summary.join(last_places, "domain", "left")

    head = F.concat(
        F.lit(f"Processing Summary\n{_DOUBLE_RULE}\nCompany: "), F.col("company_name"),
        F.lit("\nDomain: "), F.col("domain"),
        F.lit("\nFiles processed: "), F.col("processed_files").cast("string"),
        F.lit("\nTotal people found: "), F.col("total_people").cast("string"), F.lit("\n"),
    )
    fixed = [F.struct(F.lit(0).alias("block"), head.alias("text"))]
    fixed.append(F.struct(
        F.lit(9).alias("block"), F.when(~found, F.lit("No people found.")).alias("text")
    ))
    for name, title, json_title, n in lists:
        empty = F.col(f"_last_{name}").isNull()
        gap = "\n" if n > 1 else ""
        fixed += [
            F.struct(
                F.lit(2 * n - 1).alias("block"),
                F.when(found, F.lit(f"{gap}=== Unique {title} ===\n{_RULE}")).alias("text"),
            ),
            F.struct(
                F.lit(3 * n + 2).alias("block"),
                F.when(
                    found,
                    F.concat(
                        F.lit(f"\n\n=== Final {json_title} List (JSON) ===\n"),
                        F.when(empty, F.lit("[]")).otherwise(F.lit("[")),
                    ),
                ).alias("text"),
            ),
            F.struct(
                F.lit(3 * n + 4).alias("block"), F.when(found & ~empty, F.lit("]")).alias("text")
            ),
        ]
    framing = frame.select("id", "company_name", F.explode(F.array(*fixed)).alias("_b")).select(
        "id", "company_name", "_b.block", nowhere.alias("place"), "_b.text"
    ).filter(F.col("text").isNotNull())

    owned = frame.filter(found).select("id", "company_name", "domain", "_last_executive", "_last_board")
    person = F.struct("name", "role", "email", "phone")
    n = F.when(F.col("list") == "executive", 1).otherwise(2)
    last = F.when(F.col("list") == "executive", F.col("_last_executive")).otherwise(F.col("_last_board"))
    item = F.concat(
        person_json(person),
        F.when(F.col("first_seen") == last, F.lit("")).otherwise(F.lit(",")),
    )
    entries = join_hot(unique, owned, "domain", F.struct("list", "name")).select(
        "id", "company_name",
        F.explode(F.array(
            F.struct((2 * n).alias("block"), _person_lines(person).alias("text")),
            F.struct((3 * n + 3).alias("block"), item.alias("text")),
        )).alias("_b"),
        F.col("first_seen").alias("place"),
    ).select("id", "company_name", "_b.block", "place", "_b.text")
    return framing.unionByName(entries)


def write_page_summaries(processed: DataFrame, path: str, one_file_each: bool = False) -> None:
    """The reports as JSON lines `source_file, summary`.

    `one_file_each` writes one text file per page below `source_file=<name>`; that suits
    some thousands of pages.
    """
    writer = render_page_summary(processed).write.mode("overwrite")
    (writer.partitionBy("source_file").text if one_file_each else writer.json)(path)


def write_company_reports(report: DataFrame, path: str) -> None:
    """The reports below `company_name=<name>`, each in order over its files; companies of one
    name one after another, by id."""
    order = ("company_name", "id", "block", "place")
    ordered = report.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.select("company_name", F.col("text").alias("value")).write.mode("overwrite").partitionBy(
        "company_name"
    ).text(path)
