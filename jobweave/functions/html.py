"""HTML reading with regular expressions."""

from __future__ import annotations

import re
from html.entities import name2codepoint

from pyspark.sql import Column, functions as F

from jobweave import rules
from jobweave.functions.text import (
    col,
    collapse_ws,
    distinct_ignore_case,
    empty_to_null,
    filled_items,
    join_filled,
    json_unescape,
    keep_if_filled,
    last_wins,
    let,
    trim_ws,
    zipped,
)

_NAME = r"^(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"


def _named() -> Column:
    """The named entities and their characters."""
    names = {**{name: chr(code) for name, code in name2codepoint.items()}, "apos": "'"}
    return F.str_to_map(F.lit(";".join(f"{name}={character}" for name, character in names.items())), F.lit(";"), F.lit("="))


def _character(name: Column) -> Column:
    """The character of an entity's name or number; NULL when there is none.

    A number may begin with any number of zeros.
    """
    digits = F.regexp_replace(name, "^#[xX]?0*", "")
    sized = lambda most: F.when(F.length(digits) <= most, digits)
    number = F.when(F.lower(F.substring(name, 2, 1)) == "x", F.conv(sized(6), 16, 10).try_cast("int")).otherwise(sized(7).try_cast("int"))
    valid = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    numbered = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, F.lit("0"))), "UTF-32"))
    return F.when(F.startswith(name, F.lit("#")), numbered).when(name != "", F.try_element_at(_named(), name))


def _after_ampersand(part: Column) -> Column:
    """A piece of text that followed '&', its entity decoded."""
    whole = lambda name, ch: F.when(ch.isNull(), F.concat(F.lit("&"), part)).otherwise(
        F.concat(ch, F.substr(part, F.length(name) + 2))
    )
    return let(F.regexp_extract(part, _NAME, 1), lambda name: let(_character(name), lambda ch: whole(name, ch)))


def decode_entities(c) -> Column:
    """Decode HTML entities; an unknown one stays as it is."""
    decoded = lambda parts: F.concat(
        F.get(parts, F.lit(0)), F.array_join(F.transform(F.slice(parts, F.lit(2), F.size(parts)), _after_ampersand), "")
    )
    return let(col(c), lambda v: F.when(F.contains(v, F.lit("&")), let(F.split(v, "&"), decoded)).otherwise(v))


def decode_entities_in(values) -> Column:
    """Entity decoding for an array column."""
    return F.transform(col(values), decode_entities)


def clean_text(c) -> Column:
    """Decode entities, collapse white space, trim; NULL gives ''."""
    return collapse_ws(decode_entities(F.coalesce(col(c), F.lit(""))))


def strip_tags(c) -> Column:
    """Text of a fragment: every tag becomes a space, then ``clean_text``."""
    return clean_text(F.regexp_replace(col(c), rules.ANY_TAG, " "))


def strip_tags_loose(c) -> Column:
    """Tags to spaces, entities decoded, runs of two or more white spaces collapsed."""
    text = decode_entities(F.regexp_replace(F.coalesce(col(c), F.lit("")), rules.ANY_TAG, " "))
    return trim_ws(F.regexp_replace(text, r"\s{2,}", " "))


def strip_tags_plain(c) -> Column:
    """Tags to spaces and runs collapsed, without entity decoding."""
    text = F.regexp_replace(F.coalesce(col(c), F.lit("")), rules.ANY_TAG, " ")
    return trim_ws(F.regexp_replace(text, r"\s{2,}", " "))


def strip_tags_only(c) -> Column:
    """Tags to spaces and trim; NULL stays NULL."""
    return trim_ws(F.regexp_replace(col(c), rules.ANY_TAG, " "))


def first_group(c, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract(F.coalesce(col(c), F.lit("")), pattern, group)


def first_of(c, patterns: list[str]) -> Column:
    """Group 1 of the first pattern that gives something."""
    return F.coalesce(*[empty_to_null(first_group(c, p)) for p in patterns], F.lit(""))


def meta_patterns(name: str) -> list[str]:
    """The three attribute orders a <meta> tag is found in."""
    name = re.escape(name)
    return [
        rf"""(?is)<meta[^>]+property=["']{name}["'][^>]+content=\s*["']([^"']*)["']""",
        rf"""(?is)<meta[^>]+name=["']{name}["'][^>]+content=\s*["']([^"']*)["']""",
        rf"""(?is)<meta[^>]+content=["']([^"']*)["'][^>]+(?:property|name)=["']{name}["']""",
    ]


def meta(html, name: str) -> Column:
    return clean_text(first_of(html, meta_patterns(name)))


def h1(html) -> Column:
    return strip_tags(first_group(html, rules.H1))


def page_title(html) -> Column:
    """Text of the first h1, h2 or title element."""
    return strip_tags(first_group(html, rules.HEADING_OR_TITLE))


def class_text(html, class_name: str) -> Column:
    """Text of the first element whose class holds ``class_name``."""
    name = re.escape(class_name)
    return strip_tags(
        first_group(html, rf"""(?i)<[^>]+class=["'][^"']*{name}[^"']*["'][^>]*>((?s:.*?))</[^>]+>""")
    )


def attribute(attrs, name: str) -> Column:
    """Value of a quoted or bare attribute."""
    name = re.escape(name)
    return trim_ws(
        decode_entities(
            first_of(attrs, [rf"""(?i){name}=["']([^"']*)["']""", rf"""(?i){name}=([^\s>"']+)"""])
        )
    )


def hrefs(html, system: str) -> Column:
    """Raw job hrefs of a page, in page order, duplicates kept."""
    return F.regexp_extract_all(
        F.coalesce(col(html), F.lit("")), F.lit(rules.JOB_LINK_PATTERNS[system]), F.lit(1)
    )


def root_links(html) -> Column:
    """Hrefs of a page that begin at the site's root, in page order, as they are written."""
    return F.regexp_extract_all(F.coalesce(col(html), F.lit("")), F.lit(r"""href="(/[^"]*)\""""), F.lit(1))


def job_links(html, base_url, system: str) -> Column:
    """Absolute job links of a page: decoded, fragment cut, first of each (ignoring case)."""
    from jobweave.functions.url import resolve

    base_url = col(base_url)
    links = F.transform(decode_entities_in(hrefs(html, system)), lambda h: resolve(base_url, h))
    return distinct_ignore_case(links)


def table_cells(row) -> Column:
    """Texts of a row's cells, blanks and the apply button dropped."""
    raw = F.regexp_extract_all(F.coalesce(col(row), F.lit("")), F.lit(rules.TABLE_CELL), F.lit(1))
    plain = F.transform(raw, lambda x: F.regexp_replace(x, rules.ANY_TAG, " "))
    texts = F.transform(decode_entities_in(plain), collapse_ws)
    return F.filter(texts, lambda x: (x != "") & (F.lower(x) != "apply now"))


def select_options(html, select_pattern: str = rules.FRESHTEAM_TYPE_SELECT) -> Column:
    """value -> text map of a <select>; a repeated value keeps its last text."""
    options = first_group(html, select_pattern)
    keys = F.transform(
        decode_entities_in(F.regexp_extract_all(options, F.lit(rules.SELECT_OPTION), F.lit(1))), trim_ws
    )
    plain = F.transform(
        F.regexp_extract_all(options, F.lit(rules.SELECT_OPTION), F.lit(2)),
        lambda x: F.regexp_replace(x, rules.ANY_TAG, " "),
    )
    texts = F.transform(decode_entities_in(plain), collapse_ws)
    return last_wins(zipped(keys, texts, ("k", "v")))


def json_string_field(html, key: str) -> Column:
    """First "key": "value" string anywhere in a page, escapes decoded."""
    pattern = rf"""(?is)["']{re.escape(key)}["']\s*:\s*["']((?:\\.|[^"'\\])*)["']"""
    plain = lambda v: trim_ws(F.regexp_replace(F.regexp_replace(v, r"\\n", " "), r'\\(["/])', "$1"))
    return let(
        decode_entities(first_group(html, pattern)),
        lambda v: F.when(v == "", F.lit("")).otherwise(F.coalesce(json_unescape(v), plain(v))),
    )


# --- JSON-LD ------------------------------------------------------------------------

JOB_POSTING = (
    "struct<`@type`:string, `@graph`:string, title:string, description:string, url:string,"
    "datePosted:string, employmentType:string, hiringOrganization:string, jobLocation:string,"
    "applicantLocationRequirements:string, jobLocationType:string, occupationalCategory:string,"
    "industry:string, identifier:string>"
)
_ADDRESS = (
    "struct<address:string, name:string, addressLocality:string, addressRegion:string, addressCountry:string>"
)


def as_json_array(text) -> Column:
    """A JSON value as array text: arrays stay, anything else is wrapped."""
    return let(
        trim_ws(text),
        lambda v: F.when(F.startswith(v, F.lit("[")), v).otherwise(F.concat(F.lit("["), v, F.lit("]"))),
    )


def _is_posting(item: Column) -> Column:
    return F.lower(F.coalesce(item["@type"], F.lit(""))).rlike(r'^jobposting$|^\[.*"jobposting".*\]$')


def job_postings(html, use_graph: bool = True) -> Column:
    """All JSON-LD job postings of a page, in page order."""
    scripts = F.regexp_extract_all(
        F.coalesce(col(html), F.lit("")), F.lit(rules.JSON_LD_SCRIPT), F.lit(1)
    )
    items = F.flatten(
        F.transform(
            decode_entities_in(scripts),
            lambda s: F.coalesce(F.from_json(as_json_array(s), f"array<{JOB_POSTING}>"), F.array()),
        )
    )
    if use_graph:
        items = F.flatten(
            F.transform(
                items,
                lambda it: F.when(
                    F.startswith(it["@graph"], F.lit("[")),
                    F.coalesce(F.from_json(it["@graph"], f"array<{JOB_POSTING}>"), F.array()),
                ).otherwise(F.array(it)),
            )
        )
    return F.filter(items, lambda it: it.isNotNull() & _is_posting(it))


def job_posting(html, use_graph: bool = True) -> Column:
    """The first JSON-LD job posting of a page, or NULL."""
    return F.get(job_postings(html, use_graph), F.lit(0))


def posting_location(posting, name_first: bool = False, add_name: bool = False) -> Column:
    """Locations of a JSON-LD posting joined with ' | '.

    ``name_first`` prefers an explicit place name over its address; ``add_name``
    appends the name to the address parts.
    """
    posting = col(posting)
    raw = F.coalesce(posting["jobLocation"], posting["applicantLocationRequirements"])
    items = F.coalesce(F.from_json(as_json_array(raw), "array<string>"), F.array())

    def from_place(place: Column) -> Column:
        inner = F.when(place["address"].isNull(), place).when(
            F.startswith(place["address"], F.lit("{")), F.from_json(place["address"], _ADDRESS)
        )
        fields = ["addressLocality", "addressRegion", "addressCountry"] + (["name"] if add_name else [])
        # an address that is plain text stands as it is
        built = let(inner, lambda a: F.coalesce(F.when(a.isNull(), place["address"]), join_filled(", ", *[a[f] for f in fields])))
        return F.coalesce(keep_if_filled(place["name"]), built) if name_first else built

    def text(item: Column) -> Column:
        return F.when(
            F.startswith(F.ltrim(item), F.lit("{")), let(F.from_json(item, _ADDRESS), from_place)
        ).otherwise(item)

    return F.array_join(distinct_ignore_case(filled_items(F.transform(items, text))), " | ")


def posting_company(posting) -> Column:
    posting = col(posting)
    return F.coalesce(F.get_json_object(posting["hiringOrganization"], "$.name"), F.lit(""))


def posting_job_type(posting) -> Column:
    """employmentType; a list is joined with ', '."""
    value = col(posting)["employmentType"]
    return F.coalesce(
        F.when(F.startswith(value, F.lit("[")), F.array_join(F.from_json(value, "array<string>"), ", ")),
        value,
        F.lit(""),
    )


def posting_identifier(posting) -> Column:
    """identifier.value, or the identifier itself when it is a scalar."""
    value = col(posting)["identifier"]
    return F.coalesce(
        F.when(F.startswith(value, F.lit("{")), F.get_json_object(value, "$.value")).otherwise(value),
        F.lit(""),
    )
