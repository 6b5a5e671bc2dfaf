"""People of one page, as array expressions.

A page's people come out of the page's own row, so everything from sections to the two
final lists is array work inside that row: no shuffle, and no group can grow beyond one
page. Arrays keep the order of sections and of names within them.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stewardry import vocab
from stewardry.functions import urls
from stewardry.functions.spans import find_all, grouped, has_marks, let, mark, mark_copies, marked_matches, without_marks
from stewardry.schemas import PEOPLE, PERSON, SPANS

_EMAIL = "(?U)" + vocab.EMAIL_PATTERN
# Behind a quick look at the first character: a plus, a bracket, a digit of any script.
_PHONE = r"(?U)(?=[+(0123456789]|[^\x00-\x7f])" + vocab.PHONE_PATTERN

_ANY_ROLE = vocab.any_case(vocab.ROLE_PHRASES)
_ROLE_LOOK = vocab.quick_look(vocab.ROLE_PHRASES)

# Usual ways to write a role that has a standard.
_WRITTEN = {way: next(standard for pattern, standard in vocab.ROLE_STANDARDS if re.fullmatch(pattern, way)) for way in (
    "Director", "director", "President", "president", "CEO", "ceo", "CFO", "cfo", "COO", "coo", "Chairman", "chairman",
    "Chairperson", "chairperson", "Treasurer", "treasurer", "Secretary", "secretary", "VP", "IR",
)}

#: Up to so many comparisons, or entries, the plain form is faster than one that sorts.
_FEW_PAIRS, _FEW_ENTRIES = 64, 12

_CAPITALISED = r"\p{Lu}[\p{L}'’-]*\p{Ll}(?![\p{L}])"
_NAME_WORD = rf"(?!(?:{vocab.words_pattern(vocab.NOT_IN_NAMES)})(?![\p{{L}}])){_CAPITALISED}"
# Two or more capitalised words in a row, none of them a role or company word. The
# possessive loop keeps the matcher from recursing on very long runs.
NAME_PATTERN = rf"(?=\p{{Lu}})(?<![\p{{L}}'’-]){_NAME_WORD}(?:[ \t]+{_NAME_WORD})++"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def person_spans(section: Column | str) -> Column:
    """Rule-based names in a section with their offsets: `array<struct<start, text>>`."""
    return find_all(without_marks(_col(section)), NAME_PATTERN)


def role_hits(section: Column | str) -> Column:
    """Every match of every role phrase: `array<struct<rank, start, text>>`."""
    return _ranked_hits(_marked_roles(without_marks(_col(section))))


def _marked_roles(section: Column) -> Column:
    # Phrases can overlap one another, but no two begin at the same place.
    return mark_copies(section, _ANY_ROLE, _ROLE_LOOK)


def _ranked_hits(marked: Column) -> Column:
    phrases = F.array(*(F.lit(p) for p in vocab.ROLE_PHRASES))
    ranks = F.create_map(*(x for rank, p in enumerate(vocab.ROLE_PHRASES, 1) for x in (F.lit(p), F.lit(rank).cast("long"))))

    def ranked(m: Column) -> Column:
        written = F.lower(m["text"])
        phrase = F.regexp_replace(written, r"(?U)\s+", " ")
        return F.struct(
            F.coalesce(F.try_element_at(ranks, written), F.array_position(phrases, phrase)).alias("rank"),
            m["start"].alias("start"),
            m["text"].alias("text"),
        )

    return F.transform(marked_matches(marked, copies=True), ranked)


def nearest_role(hits: Column, start: Column) -> Column:
    """The role text nearest to an offset; ties go to the earlier phrase, then match."""
    nearest = F.array_min(
        F.transform(
            hits,
            lambda h: F.struct(
                F.abs(h["start"] - start).alias("distance"),
                h["rank"].alias("rank"),
                h["start"].alias("start"),
                h["text"].alias("text"),
            ),
        )
    )
    return nearest["text"]


def nearest_roles(hits: Column, spans: Column) -> Column:
    """`array<struct<span, role>>`: every span with the role text nearest to it, else NULL.

    Few are compared each with each; for more see `sorted_nearest_roles`. The rows are equal
    but for their order, which is that of `spans` where these are sorted by start.
    """
    plain = F.transform(spans, lambda s: F.struct(s.alias("span"), nearest_role(hits, s["start"]).alias("role")))
    few = F.size(hits) * F.size(spans) <= _FEW_PAIRS
    return F.when(few, plain).otherwise(sorted_nearest_roles(hits, spans))


def sorted_nearest_roles(hits: Column, spans: Column) -> Column:
    """`nearest_roles` for all spans of a section at once: hits and spans are sorted
    together, so that a span's place tells how many hits lie before it, and only the hit
    on either side has to be compared.
    """
    def ordered_hits(h: Column) -> Column:
        # of hits at one offset the earliest phrase counts
        first = F.filter(h, lambda x, i: (i == 0) | (x["start"] != F.get(h, i - 1)["start"]))
        return let(first, lambda only: let(places(only), lambda at: F.transform(at, lambda x, k: F.struct(
            F.get(spans, x["span"]).alias("span"), of_span(only, x, k).alias("role")))))

    def places(only: Column) -> Column:
        event = lambda start, span: F.struct(start.alias("start"), span.alias("span"))
        events = F.array_sort(F.concat(
            F.transform(only, lambda x: event(x["start"], F.lit(-1))), F.transform(spans, lambda x, i: event(x["start"], i))))
        numbered = F.transform(events, lambda x, i: F.struct(x["start"].alias("start"), x["span"].alias("span"), i.alias("place")))
        return F.filter(numbered, lambda x: x["span"] >= 0)

    def of_span(only: Column, x: Column, k: Column) -> Column:
        # k spans lie before this one, all else before it are hits
        before = x["place"] - k
        sides = F.filter(F.array(F.get(only, before - 1), F.get(only, before)), lambda h: h.isNotNull())
        return nearest_role(sides, x["start"])

    by_start = F.array_sort(F.transform(hits, lambda h: F.struct(
        h["start"].alias("start"), h["rank"].alias("rank"), h["text"].alias("text"))))
    return let(by_start, ordered_hits)


def extract_email(text: Column | str) -> Column:
    """First e-mail address in the text, else NULL."""
    text = _col(text)
    found = F.nullif(F.regexp_extract(text, _EMAIL, 0), F.lit(""))
    # Most texts have no '@', and looking for it is far cheaper than the pattern.
    return F.when(F.contains(text, F.lit("@")), found)


def extract_phone(text: Column | str) -> Column:
    """First phone number in the text, else NULL."""
    return F.nullif(F.regexp_extract(_col(text), _PHONE, 0), F.lit(""))


def standardize_role(role: Column | str) -> Column:
    """The long form of a short or plainly written role, other roles unchanged."""
    role = _col(role)
    trimmed = F.trim(role)
    # Few roles are written in another way than those looked up; of the others one search tells
    # whether there is a standard at all.
    known = trimmed.rlike(f"^(?:{'|'.join(p for p, _ in vocab.ROLE_STANDARDS)})$")
    standards = F.create_map(*(F.lit(x) for pair in _WRITTEN.items() for x in pair))
    result = F.when(F.coalesce(~known, F.lit(True)), role)
    for pattern, standard in vocab.ROLE_STANDARDS:
        result = result.when(trimmed.rlike(f"^(?:{pattern})$"), standard)
    return F.coalesce(F.try_element_at(standards, trimmed), result.otherwise(role))


def section_people(section: Column, spans: Column, hits: Column) -> Column:
    """The people of one section, given the name spans and the role phrases found in it.

    Every name takes the nearest role; the section's first e-mail address and phone
    number go to all of them. Names in a section without a role are dropped.
    """
    def with_facts(facts: Column) -> Column:
        def person(found: Column) -> Column:
            return let(F.trim(found["role"]), lambda role: F.struct(
                F.trim(found["span"]["text"]).alias("name"), standardize_role(role).alias("role"),
                facts["email"].alias("email"), facts["phone"].alias("phone")))

        named = F.filter(nearest_roles(facts["hits"], facts["spans"]), lambda x: x["role"].isNotNull())
        return F.transform(named, person)

    def with_spans(found: Column) -> Column:
        facts = F.struct(
            found.alias("spans"),
            hits.alias("hits"),
            extract_email(section).alias("email"),
            extract_phone(section).alias("phone"),
        )
        return F.when(F.size(found) > 0, let(facts, with_facts)).otherwise(F.array().cast(PEOPLE))

    return let(spans, with_spans)


def people_of_sections(sections: Column | str, spans: Column | str | None = None) -> Column:
    """All people of a page's sections, in order.

    `spans` may hold another recogniser's finds (`schemas.SPANS`); without it the
    rule-based names are used.
    """
    nobody = F.array().cast(PEOPLE)
    found = None if spans is None else _col(spans).cast(SPANS)

    def of_section(s: Column, i: Column) -> Column:
        def searched(plain: Column) -> Column:
            def people(marked: Column) -> Column:
                if found is None:
                    names = find_all(plain, NAME_PATTERN)
                else:
                    names = F.transform(
                        F.filter(found, lambda x: x["section"] == i),
                        lambda x: F.struct(x["start"].alias("start"), x["name"].alias("text")))
                # a control character that became a space makes no role
                held = has_marks(marked) & ((plain == s) | s.rlike(_ANY_ROLE))
                return F.when(held, section_people(s, names, _ranked_hits(marked))).otherwise(nobody)

            return let(_marked_roles(plain), people)

        return let(without_marks(s), searched)

    return F.flatten(F.transform(_col(sections), of_section))


def _is_executive(role: Column) -> Column:
    return role.isin(*vocab.EXECUTIVE_ROLES)


def _is_board(role: Column) -> Column:
    return role.isin(*vocab.BOARD_ROLES)


def _last(values: Column) -> Column:
    return F.try_element_at(values, F.lit(-1))


def dedup_people(people: Column | str) -> Column:
    """One entry per name, in order of first appearance.

    The first role stays, except that a board role gives way to the first executive one;
    the last known e-mail address and phone number win.
    """
    people = _col(people)

    def one(same: Column) -> Column:
        first = F.get(same, F.lit(0))
        executive = F.get(F.filter(same, lambda p: _is_executive(p["role"])), F.lit(0))
        return F.struct(
            first["name"].alias("name"),
            F.when(
                _is_board(first["role"]), F.coalesce(executive["role"], first["role"])
            ).otherwise(first["role"]).alias("role"),
            _last(F.filter(F.transform(same, lambda p: p["email"]), lambda v: v.isNotNull())).alias("email"),
            _last(F.filter(F.transform(same, lambda p: p["phone"]), lambda v: v.isNotNull())).alias("phone"),
        )

    def folded(people: Column) -> Column:
        by_name = _grouped(people, lambda p: p["name"])
        several = F.size(F.array_distinct(F.transform(people, lambda p: p["name"]))) < F.size(people)
        return F.when(several, F.transform(by_name, one)).otherwise(people)

    return let(people, folded)


def _grouped(people: Column, key) -> Column:
    """`spans.grouped`, by looking through the list for each key where it is short."""
    plain = F.transform(F.array_distinct(F.transform(people, key)), lambda k: F.filter(people, lambda p: F.equal_null(key(p), k)))
    return F.when(F.size(people) <= _FEW_ENTRIES, plain).otherwise(grouped(people, key))


def merge_similar_people(
    people: Column | str, keep: str = "first", merge_contacts: bool = False
) -> Column:
    """Entries absorbed by an earlier one of the same role whose name holds theirs, or
    is held by theirs.

    `keep="first"` keeps the earlier name even where it is shorter; `keep="longest"`
    takes the longer one. `merge_contacts` fills the survivor's missing contact details.
    Names are compared in lower case and trimmed; entries without a name or role stay.
    """
    if keep not in ("first", "longest"):
        raise ValueError(f"keep must be 'first' or 'longest', not {keep!r}")

    def merged(people: Column) -> Column:
        folded = _merged_one_by_one(people, keep, merge_contacts)
        if keep == "first" and not merge_contacts:
            folded = F.when(F.size(people) <= _FEW_ENTRIES, folded).otherwise(_merged_by_suffixes(people))
        return F.when(F.size(people) > 1, folded).otherwise(people)

    return let(_col(people), merged)


def _name_key(person: Column) -> Column:
    return F.lower(F.trim(person["name"]))


def _merged_one_by_one(people: Column, keep: str = "first", merge_contacts: bool = False) -> Column:
    """The survivors, every entry held against all kept before it."""
    def alike(a: Column, b: Column) -> Column:
        return (a["p"]["role"] == b["p"]["role"]) & (F.contains(a["key"], b["key"]) | F.contains(b["key"], a["key"]))

    def keyed(person: Column) -> Column:
        return F.struct(_name_key(person).alias("key"), person.alias("p"))

    def absorb(kept: Column, new: Column) -> Column:
        kept, new = kept["p"], new["p"]
        longer = F.length(new["name"]) > F.length(kept["name"])
        name = F.when(longer, new["name"]).otherwise(kept["name"]) if keep == "longest" else kept["name"]
        email, phone = kept["email"], kept["phone"]
        if merge_contacts:
            email, phone = F.coalesce(email, new["email"]), F.coalesce(phone, new["phone"])
        return let(F.struct(
            name.alias("name"), kept["role"].alias("role"),
            email.alias("email"), phone.alias("phone"),
        ), keyed)

    def step(acc: Column, new: Column) -> Column:
        known = F.exists(acc, lambda q: alike(q, new))
        if keep == "first" and not merge_contacts:
            absorbed = acc
        else:
            host = F.array_position(F.transform(acc, lambda q: alike(q, new)), True)
            absorbed = F.transform(
                acc, lambda q, i: F.when(i + 1 == host, absorb(q, new)).otherwise(q)
            )
        return F.when(known, absorbed).otherwise(F.concat(acc, F.array(new)))

    nobody = F.array().cast(T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("p", PERSON)])))
    return F.aggregate(F.transform(people, keyed), nobody, step, lambda acc: F.transform(acc, lambda x: x["p"]))


_CHAIN = "struct<role:string,held:array<struct<text:string,at:int>>,pairs:array<struct<late:int,early:int>>>"


def _merged_by_suffixes(people: Column) -> Column:
    """`_merged_one_by_one` without comparing all pairs.

    All suffixes of all names are sorted by role and text. A name held by another comes
    right before those of the other's suffixes that begin with it, so one pass with the
    chain of names that begin the present suffix finds every pair of alike entries. Pairs
    are then gone through by the later entry: it is dropped if the earlier one is kept.
    """
    def suffixes(person: Column, i: Column) -> Column:
        key = _name_key(person)
        cuts = F.when(key.isNull() | person["role"].isNull(), F.array().cast("array<int>")).otherwise(
            F.sequence(F.lit(1), F.greatest(F.length(key), F.lit(1))))
        return let(key, lambda text: F.transform(cuts, lambda c: F.struct(
            person["role"].alias("role"), F.substr(text, c).alias("text"), (c > 1).alias("inner"), i.alias("at"))))

    def step(acc: Column, e: Column) -> Column:
        same = F.when(e["role"] == acc["role"], F.filter(acc["held"], lambda h: F.startswith(e["text"], h["text"])))
        held = F.coalesce(same, F.array())

        def taken(held: Column) -> Column:
            alike = F.transform(F.filter(held, lambda h: h["at"] != e["at"]), lambda h: F.struct(
                F.greatest(h["at"], e["at"]).alias("late"), F.least(h["at"], e["at"]).alias("early")))
            whole = F.array(F.struct(e["text"].alias("text"), e["at"].alias("at")))
            return F.struct(
                e["role"].alias("role"), F.when(e["inner"], held).otherwise(F.concat(held, whole)).alias("held"),
                F.when(F.size(alike) > 0, F.concat(acc["pairs"], alike)).otherwise(acc["pairs"]).alias("pairs"))

        return let(held, taken).cast(_CHAIN)

    def survivors(pairs: Column) -> Column:
        def drop(dropped: Column, p: Column) -> Column:
            stays = F.array_contains(dropped, p["early"]) | F.equal_null(F.try_element_at(dropped, F.lit(-1)), p["late"])
            return F.when(stays, dropped).otherwise(F.concat(dropped, F.array(p["late"])))

        dropped = F.aggregate(pairs, F.array().cast("array<int>"), drop)
        return let(dropped, lambda d: F.when(F.size(d) == 0, people).otherwise(F.filter(people, lambda _, i: ~F.array_contains(d, i))))

    start = F.struct(F.lit("").alias("role"), F.array().alias("held"), F.array().alias("pairs")).cast(_CHAIN)
    ordered = F.array_sort(F.flatten(F.transform(people, suffixes)))
    return let(F.array_sort(F.array_distinct(F.aggregate(ordered, start, step, lambda acc: acc["pairs"]))), survivors)


def is_valid_name(name: Column | str, mode: str = "substring") -> Column:
    """False for names that hold a company or mining word, or are shorter than three.

    `mode="substring"` finds the words anywhere, so `Vincent` falls for `inc`;
    `mode="word"` asks for whole words.
    """
    words = vocab.words_any_case(vocab.NON_PERSON_WORDS)
    if mode == "word":
        words = rf"(?U)\b(?:{words})\b"
    elif mode != "substring":
        raise ValueError(f"mode must be 'substring' or 'word', not {mode!r}")
    name = _col(name)
    return ~name.rlike(words) & (F.length(name) >= vocab.MIN_NAME_LENGTH)


def goes_to_executives(role: Column, url: Column) -> Column:
    """True where a person of this role on this page is listed as an executive."""
    executive_page, board_page = urls.is_executive_page(url), urls.is_board_page(url)
    return (
        F.when(executive_page & ~board_page, F.lit(True))
        .when(board_page & ~executive_page, F.lit(False))
        .otherwise(_is_executive(role))
    )


def goes_to_board(role: Column, url: Column) -> Column:
    """True where a person of this role on this page is listed as a board member."""
    executive_page, board_page = urls.is_executive_page(url), urls.is_board_page(url)
    return (
        F.when(board_page & ~executive_page, F.lit(True))
        .when(executive_page & ~board_page, F.lit(False))
        .otherwise(_is_board(role) | (role == vocab.CHIEF_EXECUTIVE))
    )


def page_list(url: Column) -> Column:
    """The list that all people of a page are on, `executive` or `board`; NULL where their roles
    decide."""
    executive_page, board_page = urls.is_executive_page(url), urls.is_board_page(url)
    return F.when(executive_page, F.when(~board_page, F.lit("executive"))).otherwise(F.when(board_page, F.lit("board")))


def listed_people(people: Column, on: Column) -> tuple[Column, Column]:
    """The executives and the board members among a page's people, `on` being its `page_list`.

    As `goes_to_executives` and `goes_to_board` say, with the page looked at once.
    """
    nobody = F.array().cast(PEOPLE)
    executives = F.when(on == "executive", people).when(on == "board", nobody).otherwise(
        F.filter(people, lambda p: _is_executive(p["role"])))
    board = F.when(on == "board", people).when(on == "executive", nobody).otherwise(
        F.filter(people, lambda p: _is_board(p["role"]) | (p["role"] == vocab.CHIEF_EXECUTIVE)))
    return executives, board


def leading_title_hits(text: Column | str) -> Column:
    """Names that follow a title: `array<struct<title, name, context, start>>`.

    Each title is searched for separately, so `Vice President Ann Lee` is found under
    two titles. The text must be free of white-space runs (`collapse_whitespace`).
    Context is 50 characters either side of the match.
    """
    text = without_marks(_col(text))

    def searched(title: str) -> Column:
        # Looking for the bare word first is far cheaper than the pattern.
        marked = mark(text, rf"(?U){title}\s+{vocab.NAME_AFTER_TITLE}")
        return F.struct(
            F.lit(title).alias("title"),
            F.when(F.contains(text, F.lit(title)), marked).alias("marked"),
        )

    def of_title(search: Column) -> Column:
        def row(m: Column) -> Column:
            begin = F.greatest(m["start"] - vocab.CONTEXT_CHARS, F.lit(0))
            end = m["start"] + F.length(m["text"]) + vocab.CONTEXT_CHARS
            name_at = F.length(search["title"]) + 2
            return F.struct(
                search["title"].alias("title"),
                F.substr(m["text"], name_at).alias("name"),
                F.substr(text, begin + 1, end - begin).alias("context"),
                m["start"].alias("start"),
            )

        return F.transform(marked_matches(search["marked"]), row)

    searches = F.array(*(searched(t) for t in vocab.LEADING_TITLES))
    present = F.filter(searches, lambda s: s["marked"].isNotNull())
    return F.flatten(F.transform(present, of_title))


def dedup_by_role(people: Column | str) -> Column:
    """One entry per name and role with the last known contacts, sorted by name."""
    people = _col(people)

    def one(same: Column) -> Column:
        first = F.get(same, F.lit(0))
        return F.struct(
            first["name"].alias("name"), first["role"].alias("role"),
            _last(F.filter(F.transform(same, lambda p: p["email"]), lambda v: v.isNotNull())).alias("email"),
            _last(F.filter(F.transform(same, lambda p: p["phone"]), lambda v: v.isNotNull())).alias("phone"),
        )

    def both(p: Column) -> Column:
        return F.struct(p["name"].alias("name"), p["role"].alias("role"))

    entries = let(people, lambda found: F.transform(_grouped(found, both), one))
    # Equal names keep their order of appearance.
    placed = F.transform(
        entries, lambda p, i: F.struct(p["name"].alias("name"), i.alias("at"), p.alias("entry"))
    )
    return F.transform(F.array_sort(placed), lambda x: x["entry"])
