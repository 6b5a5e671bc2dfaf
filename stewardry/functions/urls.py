"""URL, domain and object-name expressions (Column in, Column out)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stewardry import vocab
from stewardry.functions.text import strip

_SCHEME = r"^https?://"
# What follows an optional scheme and '//' up to the path, query or fragment.
_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _contains_any(value: Column | str, words: tuple[str, ...]) -> Column:
    return _col(value).rlike(vocab.words_any_case(words))


def normalize_website(url: Column | str) -> Column:
    """Trimmed URL with `https://` in front unless it has a scheme; empty -> NULL."""
    site = F.nullif(strip(url), F.lit(""))
    return F.when(site.rlike(_SCHEME), site).otherwise(F.concat(F.lit("https://"), site))


def website_or_placeholder(url: Column | str, company_name: Column | str) -> Column:
    """The normalised site, or a placeholder made of the company name."""
    slug = F.translate(F.lower(_col(company_name)), " ", "-")
    return F.coalesce(normalize_website(url), F.concat(F.lit(vocab.PLACEHOLDER_SITE), slug))


def extract_domain(url: Column | str) -> Column:
    """What lies between the first `://` and the next `/` or `:`, in lower case."""
    url = _col(url)
    rest = F.when(
        F.contains(url, F.lit("://")), F.split_part(url, F.lit("://"), F.lit(2))
    ).otherwise(url)
    host = F.split_part(F.split_part(rest, F.lit("/"), F.lit(1)), F.lit(":"), F.lit(1))
    return F.coalesce(F.lower(host), F.lit(""))


def authority(url: Column | str) -> Column:
    """The URL's authority as written; no scheme -> '', NULL -> NULL."""
    return F.regexp_extract(_col(url), _AUTHORITY, 1)


def netloc_domain(url: Column | str) -> Column:
    """The authority with every `www.` taken out."""
    return F.replace(authority(url), F.lit("www."), F.lit(""))


def company_domain(website: Column | str) -> Column:
    """`netloc_domain` of a company's site; '' where it has none but the placeholder."""
    domain = netloc_domain(website)
    return F.when(F.startswith(_col(website), F.lit(vocab.PLACEHOLDER_SITE)), F.lit("")).otherwise(domain)


def decode_name(name: Column | str) -> Column:
    """Percent-decoded name; `+` stays, and so does a `%` that starts no escape."""
    name = _col(name)
    escaped = F.regexp_replace(F.replace(name, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(escaped), name)


def decode_name_partly(name: Column | str) -> Column:
    """Decodes `%3A` and `%2F` only."""
    colons = F.replace(_col(name), F.lit("%3A"), F.lit(":"))
    return F.replace(colons, F.lit("%2F"), F.lit("/"))


def own_name(object_name: Column | str) -> Column:
    """An object's name without the folders it lies in; a plain URL is left as it is."""
    name = _col(object_name)
    return F.when(F.contains(name, F.lit("://")), name).otherwise(F.element_at(F.split(name, "/"), -1))


def page_url(object_name: Column | str) -> Column:
    """URL a page object is named after."""
    return decode_name(F.replace(own_name(object_name), F.lit(".json"), F.lit("")))


def short_filename(object_name: Column | str) -> Column:
    """Last path part of the decoded name, query characters as `_`."""
    last = F.element_at(F.split(decode_name(object_name), "/"), -1)
    return F.translate(last, "?=&", "___")


def flat_filename(object_name: Column | str) -> Column:
    """The name after its scheme, slashes and backslashes as `_`."""
    decoded = decode_name_partly(object_name)
    rest = F.when(
        F.contains(decoded, F.lit("://")), F.split_part(decoded, F.lit("://"), F.lit(2))
    ).otherwise(decoded)
    return F.translate(rest, "/\\", "__")


def company_file_key(company_name: Column | str) -> Column:
    """Key of a company's local file."""
    return F.translate(F.lower(_col(company_name)), " /", "__")


def is_excluded(url: Column | str, words: tuple[str, ...] = vocab.EXCLUDED_BY_READER) -> Column:
    """True where the URL holds one of the words, whatever the letter case."""
    return _contains_any(url, words)


def is_executive_page(url: Column | str) -> Column:
    return _contains_any(url, vocab.EXECUTIVE_PAGE_WORDS)


def is_board_page(url: Column | str) -> Column:
    return _contains_any(url, vocab.BOARD_PAGE_WORDS)


def resolve_link(base: Column | str, href: Column | str) -> Column:
    """`href` seen from the page `base`: absolute, `//host`, `/path`, `?q`, `#f`, relative.

    Dot segments are folded as in RFC 3986, section 5.2.4.
    """
    base, href = _col(base), F.trim(_col(href))
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    root = F.regexp_extract(base, r"^((?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*)", 1)
    path = F.regexp_extract(base, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*([^?#]*)", 1)
    no_fragment = F.regexp_extract(base, r"^([^#]*)", 1)
    no_query = F.regexp_extract(base, r"^([^?#]*)", 1)
    folder = F.regexp_extract(path, r"^(.*/)", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)

    target = F.regexp_extract(href, r"^([^?#]*)", 1)
    tail = F.substr(href, F.length(target) + 1)
    joined = F.when(F.startswith(href, F.lit("/")), target).otherwise(F.concat(folder, target))
    return (
        F.when(href == "", base)
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(F.startswith(href, F.lit("//")), F.concat(scheme, F.lit(":"), href))
        .when(F.startswith(href, F.lit("#")), F.concat(no_fragment, href))
        .when(F.startswith(href, F.lit("?")), F.concat(no_query, href))
        .otherwise(F.concat(root, fold_dots(joined), tail))
    )


def fold_dots(path: Column) -> Column:
    """An absolute path without its `.` and `..` parts."""
    parts = F.split(path, "/", -1)
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, part: F.when(
            part == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(1)))
        )
        .when(part == ".", acc)
        .otherwise(F.concat(acc, F.array(part))),
    )
    ends_in_dots = path.rlike(r"(?:^|/)\.\.?$")
    folded = F.array_join(kept, "/")
    return (
        F.when(~path.rlike(r"(?:^|/)\.\.?(?:/|$)"), path)
        .when(ends_in_dots, F.concat(folded, F.lit("/")))
        .otherwise(folded)
    )
