"""Secrets in texts, and weak candidates that make up a credential together.

Strong finds are reported wherever they stand: values given to a secret's name, access
identifiers and long hexadecimal runs. A weak candidate - a login, an endpoint, the value
of a vaguer name, a bare token of mixed letters and digits - says little alone. It is
reported only where the parts that complement it stand in the same scope (a run of text
without a blank line), at most `REACH` code points away:

- an identifier needs a secret,
- a secret needs an identifier,
- an endpoint needs both.

All of it is DataFrame work. A text is searched in its own row; what is found becomes rows
of intervals, dealt by the text they are in. The interval join takes two ordered passes
over a scope's parts, one carrying the latest end of each role before, one the next start
after: no pair of parts is ever listed, and a text with thousands of parts costs a sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stewardry.operators.once import compute_once
from stewardry.session import written

#: Code points between complementary parts at most.
REACH = 400


def _either_case(pattern: str) -> str:
    """The pattern with every letter in both cases; only for patterns of plain words."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in pattern)


def _given(names: str, value: str) -> str:
    return rf"""(?:{_either_case(names)})["']?\x20*[:=]\x20*["']?{value}"""


#: What is searched for, in the order of reporting and of precedence. Every pattern means the
#: same to Java and to RE2.
PATTERNS = {
    # fixed values: the three strong kinds, runs already of their least lengths
    "assign": _given("password|passwd|secret|token|api_?key", "([A-Za-z0-9+/_.=-]+)"),
    "access": "AKIA[A-Z0-9]{16,}",
    "hex": "[0-9a-f]{24,}",
    # weak candidates
    "id": _given("access_?key_?id|client_?id|account_?id|user_?name|login", "[A-Za-z0-9._@+-]{3,}"),
    "endpoint": r"""(?:https?|ftps?|jdbc:[a-z0-9]+|postgres|postgresql|mysql|mongodb|redis|amqps?|s3)://[^\x00-\x20"'<>]+|"""
                + _given("host|hostname|server|endpoint", r"[A-Za-z0-9.-]+\.[A-Za-z]{2,}"),
    "key": _given("secret_?access_?key|access_?key|private_?key|auth_?key|account_?key|passphrase|pwd", "[A-Za-z0-9+/_.=-]{4,}"),
    "bare": "[A-Za-z0-9+/_-]{32,}={0,2}",
}
KINDS = tuple(PATTERNS)
STRONG = KINDS[:3]
ROLES = {"assign": "secret", "access": "identifier", "hex": "secret", "id": "identifier",
         "endpoint": "endpoint", "key": "secret", "bare": "secret"}
#: A blank line ends a scope.
SCOPE_END = r"\n[\x20\t\r]*\n"
#: The least length of the value that a secret's name is given.
LEAST_VALUE = 6

_OPEN, _CLOSE = "\x01", "\x02"
#: Kinds of rows that are no finds: the end of a scope, and one that stands for the document.
_BREAK, _DOCUMENT = -1, -2
_PIECES = "array<struct<kind:int,i:int,size:int,n:int,value:string>>"
_SPANS = "array<struct<start:bigint,kind:int,end:bigint,value:string,scope:bigint>>"


def _holds(kind: str, value: Column) -> Column:
    """Whether a match counts; a match that does not is dropped, not searched again."""
    if kind == "assign":
        return F.length(F.regexp_extract(value, PATTERNS["assign"], 1)) >= LEAST_VALUE
    if kind == "bare":
        return value.rlike("[a-z]") & value.rlike("[A-Z]") & value.rlike("[0-9]")
    return F.lit(True)


def _pieces(text: Column, kind: int, pattern: str, value) -> Column:
    """The text cut before every match: a row of sizes that tells where the matches are.

    `i` is the piece's number, `size` its code points, `n` those of the match it begins with
    (0: none that counts).
    """
    # no pattern tells one control character from another
    marked = F.regexp_replace(F.translate(text, _OPEN + _CLOSE, "\x03\x03"), f"({pattern})", f"{_OPEN}$1{_CLOSE}")

    def piece(p: Column, i: Column) -> Column:
        match = F.substring_index(p, _CLOSE, 1)
        counts = (i > 0) & (value(match) if value else F.lit(True))
        return F.struct(
            F.lit(kind).alias("kind"), i.alias("i"), (F.length(p) - F.when(i > 0, 1).otherwise(0)).alias("size"),
            F.when(counts, F.length(match)).otherwise(0).alias("n"), F.when(counts, match).alias("value"))

    return F.transform(F.split(marked, _OPEN, -1), piece)


def scanned(docs: DataFrame) -> DataFrame:
    """`doc_id, _row, _pieces`, a row per document: written, so that texts are read once."""
    text = F.col("text")
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("_row"))
    searched = compute_once(rows, **{f"_has_{k}": F.coalesce(text.rlike(p), F.lit(False)) for k, p in PATTERNS.items()})
    has = {k: F.col(f"_has_{k}") for k in KINDS}
    nothing = F.array().cast(_PIECES)

    def of(kind: str) -> Column:
        return _pieces(text, KINDS.index(kind), PATTERNS[kind], lambda v: _holds(kind, v)).cast(_PIECES)

    strong = [F.when(has[k], of(k)).otherwise(nothing) for k in STRONG]
    # weak parts matter only beside an identifier and a secret
    both = (has["access"] | has["id"]) & (has["assign"] | has["hex"] | has["key"] | has["bare"])
    weak = [F.when(has[k], of(k)).otherwise(nothing) for k in KINDS[3:]]
    breaks = _pieces(text, _BREAK, SCOPE_END, None).cast(_PIECES)
    weak_pieces = F.when(both, F.concat(*weak, breaks)).otherwise(nothing)
    document = F.struct(F.lit(_DOCUMENT), F.lit(0), F.lit(0), F.lit(0), F.lit(None).cast("string"))
    pieces = F.when(F.exists(F.array(*has.values()), lambda h: h), F.concat(F.array(document).cast(_PIECES), *strong, weak_pieces))
    return written(searched.select("doc_id", "_row", pieces.alias("_pieces")), "secrets")


def _intervals(rows: DataFrame) -> DataFrame:
    """`doc_id, _row, kind, start, end, value, scope`: every match that counts, and a row of
    the kind _DOCUMENT for each document.

    Dealt by the document's row once; all that follows is sorted within it.
    """
    pieces = rows.select("doc_id", "_row", F.inline("_pieces")).repartition("_row")
    before = Window.partitionBy("_row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)).cast("long"))
    ended = Window.partitionBy("_row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    scoped = placed.withColumn("scope", F.count(F.when((F.col("kind") == _BREAK) & (F.col("i") > 0), 1)).over(ended))
    return scoped.where((F.col("n") > 0) & (F.col("kind") >= 0) | (F.col("kind") == _DOCUMENT)).select(
        "doc_id", "_row", "kind", "start", (F.col("start") + F.col("n")).alias("end"), "value", "scope")


def _nearest(condition: Column, within: list[str]) -> tuple[Column, Column]:
    """The latest end among earlier intervals and the first start among later ones that meet
    the condition, of those alike in `within`."""
    order = Window.partitionBy(*within).orderBy("start", "end", "kind")
    condition = condition & (F.col("kind") >= 0)
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    return F.max(F.when(condition, F.col("end"))).over(before), F.min(F.when(condition, F.col("start"))).over(after)


def _linked(parts: DataFrame, reach: int) -> DataFrame:
    """Of intervals: the strong, and the weak that complement others (see the module)."""
    kind = F.col("kind")
    # a candidate that shares characters with a find of an earlier kind is that find
    overlapped = F.lit(False)
    for weak in KINDS[len(STRONG):]:
        k = KINDS.index(weak)
        earlier = len(STRONG) if k == len(STRONG) else k
        ended, begins = _nearest(kind < earlier, ["_row"])
        shares = (ended > F.col("start")) | (begins < F.col("end"))
        overlapped = F.when(kind == k, F.coalesce(shares, F.lit(False))).otherwise(overlapped)
    parts = parts.withColumn("_overlapped", overlapped).where("NOT _overlapped").drop("_overlapped")

    def near(role: str) -> Column:
        ended, begins = _nearest(kind.isin(*(KINDS.index(k) for k in KINDS if ROLES[k] == role)), ["_row", "scope"])
        return F.coalesce((F.col("start") - ended <= reach) | (begins - F.col("end") <= reach), F.lit(False))

    parts = parts.withColumns({"_secret": near("secret"), "_identifier": near("identifier")})
    needs = {"identifier": F.col("_secret"), "secret": F.col("_identifier"), "endpoint": F.col("_secret") & F.col("_identifier")}
    reported = kind < len(STRONG)
    for weak in KINDS[len(STRONG):]:
        reported = reported | ((kind == KINDS.index(weak)) & needs[ROLES[weak]])
    return parts.where(reported).drop("_secret", "_identifier")


def found_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """Per document: doc_id and `found`, the reported spans by start, then kind.

    `found` is `array<struct<start, kind, end, value, scope>>`: `kind` an index into KINDS,
    offsets in code points, the end exclusive, `scope` the number of blank lines before (0 in
    a text without an identifier and a secret). Null and empty texts have no spans; repeated
    rows and null ids come out as often as they go in; no documents, no rows. Other columns
    do not matter.
    """
    rows = scanned(docs)
    span = F.when(F.col("kind") >= 0, F.struct("start", "kind", "end", "value", "scope"))
    parts = _linked(_intervals(rows.where("_pieces IS NOT NULL")), reach)
    found = parts.groupBy("_row", "doc_id").agg(F.sort_array(F.collect_list(span)).cast(_SPANS).alias("found"))
    without = rows.where("_pieces IS NULL").select("doc_id", F.array().cast(_SPANS).alias("found"))
    return found.select("doc_id", "found").unionByName(without)


def span_list(spans: Column) -> Column:
    """Spans as `kind:start:end`, joined by commas."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def secret_digests(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked.

    `spans` lists all that `found_secrets` reports, `base_sha256` digests the strong kinds
    alone, `n_linked` counts the weak candidates reported.
    """
    found = F.col("found")

    def count(first: int, last: int) -> Column:
        return F.size(F.filter(found, lambda s: s["kind"].between(first, last))).cast("long")

    strong = F.filter(found, lambda s: s["kind"] < len(STRONG))
    return found_secrets(docs, reach).select(
        "doc_id", *(count(k, k).alias(f"n_{name}") for k, name in enumerate(STRONG)),
        F.sha2(span_list(strong), 256).alias("base_sha256"), span_list(found).alias("spans"),
        count(len(STRONG), len(KINDS)).alias("n_linked"),
    )
