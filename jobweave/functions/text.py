"""Text cleaning, keys and small string rules (Column in, Column out)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from jobweave import rules


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value, fn) -> Column:
    """``fn`` of a value that is computed once per row however often ``fn`` uses it.

    Long chains over one cleaned text stay small in generated code that way.  ``fn`` must
    be built from built-ins.
    """
    return F.get(F.transform(F.array(col(value)), fn), F.lit(0))


def trim_ws(c) -> Column:
    """Trim Unicode white space at both ends (Spark's plain trim takes spaces only)."""
    return F.trim(col(c), F.lit(rules.WHITESPACE))


def _ltrim_ws(c) -> Column:
    """Trim the beginning only: enough for a blank test, and it stops at the first character."""
    return F.ltrim(col(c), F.lit(rules.WHITESPACE))


def is_blank(c) -> Column:
    return F.coalesce(_ltrim_ws(c), F.lit("")) == ""


def empty_to_null(c) -> Column:
    """The value, or NULL when it is ''."""
    return let(col(c), lambda v: F.when(v != "", v))


def blank_to_null(c) -> Column:
    """Trimmed value, or NULL when nothing is left."""
    return empty_to_null(trim_ws(c))


def keep_if_filled(c) -> Column:
    """The value as it is (untrimmed), or NULL when blank."""
    return let(col(c), lambda v: F.when(~is_blank(v), v))


def normalize_key(c) -> Column:
    """Key form of a value: trimmed, lower case, '' when blank."""
    return F.coalesce(F.lower(trim_ws(c)), F.lit(""))


def truncate(c, length: int) -> Column:
    return F.left(F.coalesce(col(c), F.lit("")), F.lit(length))


def clean(c, length: int | None = None) -> Column:
    """Stored form of a value: trimmed, NULL when blank, cut to ``length``."""
    value = blank_to_null(c)
    return value if length is None else F.left(value, F.lit(length))


def fingerprint(title, company, location) -> Column:
    """title|company|location in key form; '' unless title and company are filled."""
    parts = F.array(normalize_key(title), normalize_key(company), normalize_key(location))
    return let(parts, lambda p: F.when((p[0] == "") | (p[1] == ""), F.lit("")).otherwise(F.array_join(p, "|")))


def first_non_empty(*values) -> Column:
    """First filled value, trimmed; '' if there is none."""
    return F.coalesce(*[blank_to_null(v) for v in values], F.lit(""))


def first_non_empty_raw(*values) -> Column:
    """First filled value without trimming; '' if there is none."""
    return F.coalesce(*[keep_if_filled(v) for v in values], F.lit(""))


def same(a, b) -> Column:
    """Equality after trimming, ignoring case; NULL equals blank."""
    return normalize_key(a) == normalize_key(b)


def collapse_ws(c) -> Column:
    # a single space stays as it is, so most texts are not built anew
    return trim_ws(F.regexp_replace(col(c), r"\s{2,}|[^\S ]", " "))


def alnum_lower(c) -> Column:
    """Letters and digits only, lower case."""
    return F.coalesce(F.regexp_replace(F.lower(col(c)), r"[^\p{L}\p{Nd}]", ""), F.lit(""))


def upper_first(c) -> Column:
    return let(col(c), lambda v: F.concat(F.upper(F.left(v, F.lit(1))), F.substr(v, F.lit(2))))


def contains_any(c, words: list[str]) -> Column:
    """True when the lower-cased value holds any of ``words``; NULL counts as ''."""
    value = F.coalesce(F.lower(col(c)), F.lit(""))
    any_word = lambda v: reduce(lambda a, b: a | b, [F.contains(v, F.lit(w)) for w in words])
    return any_word(value) if len(words) < 3 else let(value, any_word)


def join_filled(separator: str, *values) -> Column:
    """Join the filled values, unchanged, with ``separator``."""
    return F.concat_ws(separator, *[keep_if_filled(v) for v in values])


def distinct_ignore_case(values) -> Column:
    """Distinct ignoring case; the first spelling of each value stays, in order.

    The pairwise search runs only for arrays that hold a repeated value.
    """

    def first(found: Column) -> Column:
        repeated = F.size(F.array_distinct(F.transform(found, F.lower))) < F.size(found)
        once = F.aggregate(
            found,
            F.array().cast("array<string>"),
            lambda kept, x: F.when(F.exists(kept, lambda y: F.lower(y) == F.lower(x)), kept).otherwise(
                F.array_append(kept, x)
            ),
        )
        return F.when(repeated, once).otherwise(found)

    return let(values, first)


def zipped(left, right, names: tuple[str, str]) -> Column:
    """Array of structs from two arrays of one length."""
    return F.zip_with(left, right, lambda a, b: F.named_struct(F.lit(names[0]), a, F.lit(names[1]), b))


def last_wins(pairs) -> Column:
    """Map of an array of (k, v) string pairs; a repeated key keeps its last value."""
    backward = lambda ps: F.reverse(F.transform(ps, lambda p: p["k"]))
    last = lambda ps, ks: F.filter(ps, lambda p, i: F.array_position(ks, p["k"]) == F.size(ks) - i)
    return F.map_from_entries(let(pairs, lambda ps: let(backward(ps), lambda ks: last(ps, ks))))


def filled_items(values) -> Column:
    """Array without NULL and blank items."""
    return F.filter(col(values), lambda x: ~is_blank(x))


def split_list(c) -> Column:
    """Parts of a ';' or ',' list: trimmed, filled, distinct ignoring case."""
    parts = F.transform(F.split(F.coalesce(col(c), F.lit("")), "[;,]"), trim_ws)
    return distinct_ignore_case(F.filter(parts, lambda x: x != ""))


def company_from_domain(domain, prefix_pattern: str | None = None) -> Column:
    """A readable company name from a host's first label."""

    def name(host: Column) -> Column:
        label = F.split_part(host, F.lit("."), F.lit(1))
        if prefix_pattern:
            label = F.regexp_replace(label, prefix_pattern, "")
        words = trim_ws(F.regexp_replace(label, "[-_]+", " "))
        return F.coalesce(empty_to_null(upper_first(words)), host)

    return let(F.coalesce(col(domain), F.lit("")), name)


def company_from_tenant(tenant, domain) -> Column:
    """Company name from the tenant key, or from the host when there is none."""
    key = F.coalesce(
        keep_if_filled(tenant), F.split_part(F.coalesce(col(domain), F.lit("")), F.lit("."), F.lit(1))
    )
    return upper_first(trim_ws(F.regexp_replace(key, "[_-]+", " ")))


# --- title rules ------------------------------------------------------------------


def cut_after_bar(c) -> Column:
    return trim_ws(F.regexp_replace(col(c), r"(?s)\s*\|\s*.*$", ""))


def strip_hiring_for(c) -> Column:
    return trim_ws(F.regexp_replace(col(c), r"(?i)^Hiring for\s+", ""))


def strip_career_page(c) -> Column:
    """Drop '| …', '- Company - Career Page' and '- JazzHR' endings."""
    value = trim_ws(F.regexp_replace(trim_ws(c), r"\s+\|\s+.*$", ""))
    value = trim_ws(F.regexp_replace(value, r"(?i)\s+-\s+.+?\s+-\s+Career Page\s*$", ""))
    return trim_ws(F.regexp_replace(value, r"(?i)\s+-\s+JazzHR\s*$", ""))


def strip_careers_suffix(c) -> Column:
    return trim_ws(F.regexp_replace(col(c), r"(?i)\s*[-|]\s*(Careers|Jobs).*$", ""))


def title_before_at(c) -> Column:
    """'Role at Company' gives 'Role'; other titles stay."""
    return let(
        col(c),
        lambda v: F.when(
            F.contains(v, F.lit(" at ")), trim_ws(F.split_part(v, F.lit(" at "), F.lit(1)))
        ).otherwise(v),
    )


def company_after_at(c) -> Column:
    """'Role at Company' gives 'Company'; otherwise ''."""
    c = col(c)
    return F.when(
        F.contains(c, F.lit(" at ")), trim_ws(F.split_part(c, F.lit(" at "), F.lit(-1)))
    ).otherwise("")


def company_from_career_page_title(c) -> Column:
    return trim_ws(
        F.coalesce(
            F.regexp_extract(trim_ws(c), r"(?i)\s+-\s+(.+?)\s+-\s+Career Page\s*$", 1), F.lit("")
        )
    )


def company_after_bar(c) -> Column:
    return collapse_ws(F.regexp_extract(F.coalesce(col(c), F.lit("")), r"\|\s*(.+)$", 1))


def label_value(c, label: str, stop_at_colon: bool = False) -> Column:
    """Value of 'Label: value' in running text, up to the next 'Word…:' label.

    ``stop_at_colon`` is the stricter form that also ends at 'Description' and
    'Key Responsibilities'.  Uses look-ahead, so it has no RE2 twin.
    """
    if stop_at_colon:
        body = r"([^.:\r\n]+?)(?=\s+[A-Z][A-Za-z ]{2,}:|\s+Description\b|\s+Key Responsibilities\b|$)"
    else:
        body = r"([^.\r\n]+?)(?=\s+[A-Z][A-Za-z ]{2,}:|$)"
    pattern = r"(?i)\b" + label + r":\s*" + body
    return collapse_ws(F.regexp_extract(F.coalesce(col(c), F.lit("")), pattern, 1))


def json_unescape(c) -> Column:
    """Decode the escapes of a JSON string body cut out of a page."""
    wrapped = F.concat(F.lit('{"v":"'), col(c), F.lit('"}'))
    return F.from_json(wrapped, "v string", {"allowUnquotedControlChars": "true"})["v"]


def location_candidate(c) -> Column:
    """A location found in a page: cut at prose headings, '' when it is prose itself."""
    value = collapse_ws(F.coalesce(col(c), F.lit("")))
    for pattern in rules.LOCATION_CUTS:
        value = F.regexp_replace(value, pattern, "")
    value = trim_ws(F.replace(value, F.lit("**"), F.lit("")))
    value = trim_ws(F.trim(value, F.lit("-:|,.")))
    return let(
        value,
        lambda v: F.when(v.rlike(rules.LOCATION_PROSE), F.lit("")).otherwise(v),
    )


def looks_like_date(c) -> Column:
    from jobweave.functions.dates import parse_date

    return parse_date(c).isNotNull()


def best_title(anchor, cells) -> Column:
    """Most title-like text among a row's link text and cells.

    Dates, job codes, job types and texts without letters are out; a text with a
    role word wins over an earlier one without.
    """
    anchor = F.coalesce(col(anchor), F.lit(""))
    candidates = F.transform(F.concat(F.array(anchor), F.coalesce(col(cells), F.array())), collapse_ws)
    candidates = F.filter(
        candidates,
        lambda x: (x != "")
        & x.rlike("[A-Za-z]")
        & ~x.rlike(rules.JOB_CODE)
        & ~x.rlike(rules.JOB_TYPE_CELL)
        & ~looks_like_date(x),
    )
    role = lambda cs: F.filter(cs, lambda x: x.rlike(rules.TITLE_ROLE_WORDS))
    best = let(candidates, lambda cs: F.coalesce(F.get(role(cs), F.lit(0)), F.get(cs, F.lit(0))))
    return F.coalesce(best, anchor)
