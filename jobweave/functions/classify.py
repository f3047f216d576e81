"""Classification from rule tables: category, job type, IT score, remote, availability."""

from __future__ import annotations

from functools import reduce
from itertools import groupby

from pyspark.sql import Column, functions as F

from jobweave import rules
from jobweave.functions.text import blank_to_null, col, contains_any, is_blank, let, trim_ws


def rule_label(text, table: rules.RuleTable) -> Column:
    """Label of the first rule whose pattern is found (ignoring case), or NULL.

    The patterns are lower case, so the text is lowered once instead of matching
    without case.
    """

    def first(t: Column) -> Column:
        chain = F
        for rule in table.rules:
            chain = chain.when(t.rlike(rule.pattern), F.lit(rule.label))
        return chain

    return let(F.lower(F.coalesce(col(text), F.lit(""))), first)


def by_rules(text, table: rules.RuleTable) -> Column:
    """``rule_label``, or the table's default."""
    return F.coalesce(rule_label(text, table), F.lit(table.default))


def _title_and_text(title, description) -> Column:
    blank = F.lit("")
    return F.concat_ws(" ", F.coalesce(col(title), blank), F.coalesce(col(description), blank))


def infer_category(title, description=None, table: str | rules.RuleTable = "tech") -> Column:
    table = rules.CATEGORY_RULE_TABLES[table] if isinstance(table, str) else table
    if description is None:
        return by_rules(title, table)
    return by_rules(_title_and_text(title, description), table)


def normalize_category(category, title, description,
                       table: rules.RuleTable = rules.TECH_CATEGORY_RULES) -> Column:
    """Category of at most 30 characters.

    A canonical name stays (in its canonical spelling); otherwise it is inferred from
    title and description; otherwise the given text is cut.
    """
    given = blank_to_null(category)
    names = F.create_map(
        *[F.lit(x) for name in rules.CANONICAL_CATEGORIES for x in (name.lower(), name)]
    )
    known = F.try_element_at(names, F.lower(given))
    inferred = rule_label(_title_and_text(title, description), table)
    return F.coalesce(known, inferred, given, F.lit(""))


def infer_job_type(text) -> Column:
    return by_rules(text, rules.JOB_TYPE_RULES)


def normalize_job_type(c) -> Column:
    """Known types in one spelling; other filled values stay, trimmed."""
    value = F.coalesce(col(c), F.lit(""))
    inferred = infer_job_type(value)
    unknown = (inferred == "Full time") & ~value.rlike("(?i)" + rules.FULL_TIME_PATTERN)
    return F.when(is_blank(value), F.lit("")).when(unknown, trim_ws(value)).otherwise(inferred)


def job_type_in_text(c) -> Column:
    return by_rules(c, rules.TEXT_JOB_TYPE_RULES)


def _words_pattern(words) -> str:
    """Pattern for any of the words, the longest first.

    Common beginnings are factored out, so a word boundary costs one look at the next
    character instead of a try of every word.
    """

    def branch(endings: list[str]) -> str:
        firsts: dict[str, list[str]] = {}
        for ending in endings:
            if ending:
                firsts.setdefault(ending[0], []).append(ending[1:])
        options = "|".join(
            ("\\" + ch if ch in ".+*?()[]{}|^$\\" else ch) + branch(rest) for ch, rest in sorted(firsts.items())
        )
        if not options:
            return ""
        return f"(?:{options})?" if "" in endings else f"(?:{options})"

    return r"\b" + branch(sorted(set(words))) + r"\b"


def it_score(title, category, description, table=rules.IT_RULES) -> Column:
    """Sum of weights over keyword hits; one pattern pass per (field, weight)."""
    fields = {"title": title, "category": category, "description": description}
    key = lambda r: (r.field, r.weight)
    parts = []
    for (field, weight), group in groupby(sorted(table, key=key), key=key):
        words = [w for r in group for w in r.words]
        text = F.lower(F.coalesce(col(fields[field]), F.lit("")))
        parts.append(F.regexp_count(text, F.lit(_words_pattern(words))) * weight)
    return reduce(lambda a, b: a + b, parts).cast("int")


def is_it(title, category, description=None, table=rules.IT_RULES) -> Column:
    return it_score(title, category, F.lit("") if description is None else description, table) > 0


def with_it_flags(df, title="title", category="category", description="description",
                  flag="is_it", score="it_score", table=rules.IT_RULES):
    """Add (or replace) the IT flag and score columns."""
    return df.withColumn(score, it_score(title, category, description, table)).withColumn(
        flag, F.col(score) > 0
    )


def remote_in(source: str, *values) -> Column:
    """Remote by the source's keyword list over its joined values."""
    filled = [F.when(~is_blank(v), col(v)) for v in values]
    return contains_any(F.concat_ws(" ", *filled), rules.REMOTE_WORDS[source])


def personio_remote(*values) -> Column:
    """Remote words present, unless a non-US country is named without the US."""
    text = F.lower(F.concat_ws(" ", *[F.when(~is_blank(v), col(v)) for v in values]))
    home = F.contains(text, F.lit("united states")) | text.rlike(r"\busa?\b")
    return text.rlike(rules.PERSONIO_REMOTE) & (~contains_any(text, rules.PERSONIO_NON_US) | home)


def jobsoid_remote(job_type, title, description, country) -> Column:
    """Remote words present and the country blank or the US."""
    blank = F.lit("")
    text = F.lower(F.concat_ws(" ", *[F.coalesce(col(c), blank) for c in (job_type, title, description)]))
    us = F.lower(F.coalesce(col(country), blank)).isin(*rules.US_COUNTRY_NAMES)
    return text.rlike(rules.JOBSOID_REMOTE) & (is_blank(country) | us)


def names_non_us_country(c) -> Column:
    return contains_any(c, rules.FRESHTEAM_NON_US)


def availability(status_code, has_posting, title) -> Column:
    """Detail status of a posting from the captured response.

    ``has_posting`` tells whether the body held a posting object; NULL when the body
    could not be read.
    """
    code = blank_to_null(col(status_code).cast("string"))
    ok = code.rlike("^2[0-9][0-9]$")
    return (
        F.when(code.isNull(), F.lit("error"))
        .when(ok & has_posting.isNull(), F.lit("error"))
        .when(ok & ~has_posting, F.lit("unknown"))
        .when(ok & ~is_blank(title), F.lit("live"))
        .when(ok, F.lit("missing_title"))
        .when(code == "429", F.lit("throttled"))
        .when(code == "404", F.lit("not_found"))
        .otherwise(F.concat(F.lit("http_"), code))
    )


def tenant_priority(domain) -> Column:
    """Rank score of a tenant name: IT words up, other trades down."""
    compact = F.regexp_replace(
        F.lower(F.split_part(F.coalesce(col(domain), F.lit("")), F.lit("."), F.lit(1))), "[^a-z0-9]+", ""
    )

    def score(name: Column) -> Column:
        hit = lambda ok, points: F.when(ok, F.lit(points)).otherwise(0)
        parts = [hit(F.contains(name, F.lit(w)), 3) for w in rules.IT_TENANT_SIGNALS]
        parts += [hit(F.contains(name, F.lit(w)), -4) for w in rules.NON_IT_TENANT_SIGNALS]
        parts.append(hit(name.rlike(rules.PREFERRED_TENANTS), 5))
        parts.append(hit(name.rlike(rules.AVOIDED_TENANTS), -5))
        return reduce(lambda a, b: a + b, parts)

    return let(compact, score)
