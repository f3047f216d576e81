"""Registration, table access, and the SQL fragments the comparison queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from jobweave import rules

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with its SQL twin where there is one."""

    def add(fn: Query) -> Query:
        if name in REGISTRY:
            raise ValueError(name)
        REGISTRY[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:  # one footer read per table, not one per query
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


# --- SQL fragments ------------------------------------------------------------------


def q(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


WS = q(rules.WHITESPACE)


def s_trim(x: str) -> str:
    return f"trim({x}, {WS})"


def s_key(x: str) -> str:
    return f"coalesce(lower({s_trim(x)}), '')"


def s_clean(x: str, n: int | None = None) -> str:
    v = f"nullif({s_trim(x)}, '')"
    return v if n is None else f"left({v}, {n})"


def s_blank(x: str) -> str:
    return f"(coalesce({s_trim(x)}, '') = '')"


def s_first(*xs: str) -> str:
    return "coalesce(" + ", ".join(s_clean(x) for x in xs) + ", '')"


def s_fingerprint(t: str, c: str, loc: str) -> str:
    return (
        f"CASE WHEN {s_key(t)} = '' OR {s_key(c)} = '' THEN '' "
        f"ELSE {s_key(t)} || '|' || {s_key(c)} || '|' || {s_key(loc)} END"
    )


def s_any(x: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower(coalesce({x}, '')), {q(w)})" for w in words) + ")"


def s_match(x: str, pattern: str) -> str:
    return f"regexp_matches(coalesce({x}, ''), {q(pattern)})"


def s_is_us(x: str) -> str:
    return f"({s_any(x, rules.US_WORDS + rules.US_CITIES)} OR {s_match(x, rules.US_STATE_PATTERN)})"


def s_rules(text: str, table_: rules.RuleTable) -> str:
    whens = " ".join(f"WHEN {s_match(text, '(?i)' + r.pattern)} THEN {q(r.label)}" for r in table_.rules)
    return f"CASE {whens} ELSE {q(table_.default)} END"


def s_words(words) -> str:
    return r"(?i)\b(?:" + "|".join(sorted(words, key=lambda w: (-len(w), w))) + r")\b"


def s_it_score(title: str, category: str, description: str) -> str:
    cols = {"title": title, "category": category, "description": description}
    parts = [
        f"{r.weight} * len(regexp_extract_all(coalesce({cols[r.field]}, ''), {q(s_words(r.words))}))"
        for r in rules.IT_RULES
    ]
    return "CAST(" + " + ".join(f"({p})" for p in parts) + " AS INTEGER)"


_CITY_STATE = r"(?i)^\s*([^,]+),\s*(" + "|".join(rules.US_STATE_CODES + ["DC"]) + r")\b"


def s_city(x: str) -> str:
    return s_clean(f"regexp_extract(coalesce({x}, ''), {q(_CITY_STATE)}, 1)")


def s_state(x: str) -> str:
    return f"nullif(upper(regexp_extract(coalesce({x}, ''), {q(_CITY_STATE)}, 2)), '')"


def s_category(category: str, title: str, description: str) -> str:
    """The category normaliser."""
    known = " ".join(
        f"WHEN lower({s_trim(category)}) = {q(c.lower())} THEN {q(c)}" for c in rules.CANONICAL_CATEGORIES
    )
    text = f"(coalesce({title}, '') || ' ' || coalesce({description}, ''))"
    inferred = f"nullif({s_rules(text, rules.TECH_CATEGORY_RULES)}, '')"
    return f"coalesce(CASE {known} END, {inferred}, {s_clean(category)}, '')"


def s_host(x: str) -> str:
    return f"coalesce(lower(nullif(regexp_extract({x}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1), '')), '')"


def s_url_path(x: str) -> str:
    return f"regexp_extract({x}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+([^?#]*)', 1)"


def s_digest(x: str) -> str:
    return f"left(sha256(lower({x})), 32)"


def s_parts(x: str) -> str:
    """Places of a list: trimmed, filled, distinct ignoring case (first spelling)."""
    raw = f"list_filter(list_transform(regexp_split_to_array(coalesce({x}, ''), '[;|]'), lambda p: {s_trim('p')}), lambda p: p <> '')"
    low = f"list_transform({raw}, lambda p: lower(p))"
    return f"list_filter({raw}, lambda p, i: list_position({low}, lower(p)) = i)"
