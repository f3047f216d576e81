"""Reading loosely typed JSON values.

Payload schemas declare uncertain fields as string; ``from_json`` then hands over
scalars as text and objects or arrays as their JSON text.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from jobweave import rules
from jobweave.functions.text import (
    col,
    contains_any,
    distinct_ignore_case,
    filled_items,
    first_non_empty,
    is_blank,
    keep_if_filled,
    last_wins,
    let,
    trim_ws,
    zipped,
)


def scalar(c) -> Column:
    """Text of a string, number or boolean; NULL for an object or array."""
    return let(col(c), lambda v: F.when(~v.rlike(r"^\s*[\[{]"), v))


def text_or_descriptor(c) -> Column:
    """A scalar, or the descriptor, name or value of an object."""
    inside = lambda v: F.coalesce(*[F.get_json_object(v, f"$.{f}") for f in ("descriptor", "name", "value")])
    return let(col(c), lambda v: F.when(v.rlike(r"^\s*\{"), inside(v)).otherwise(scalar(v)))


def object_field(c, field: str) -> Column:
    """A scalar field of a value that may be an object."""
    return let(
        col(c), lambda v: F.when(v.rlike(r"^\s*\{"), scalar(F.get_json_object(v, f"$.{field}")))
    )


def as_items(c) -> Column:
    """Items of an array value (objects as JSON text), or the single value."""
    return let(
        trim_ws(c),
        lambda v: F.when(v.isNull(), F.array().cast("array<string>"))
        .when(F.startswith(v, F.lit("[")), F.coalesce(F.from_json(v, "array<string>"), F.array()))
        .otherwise(F.array(v)),
    )


_NAMED = "struct<name:string,label:string,value:string,title:string>"
_META = (
    "struct<name:string,label:string,key:string,title:string,value:string,display_value:string,displayValue:string>"
)


def names(c) -> Column:
    """Names of an array or object (or plain strings), distinct, joined with ' / '."""

    def one(item: Column) -> Column:
        fields = ("name", "label", "value", "title")
        found = lambda n: first_non_empty(*[scalar(n[f]) for f in fields])
        return F.when(item.rlike(r"^\s*\{"), let(F.from_json(item, _NAMED), found)).otherwise(item)

    return F.array_join(distinct_ignore_case(filled_items(F.transform(as_items(c), one))), " / ")


def metadata_value(c, wanted: list[str], unwanted: tuple[str, ...] = ()) -> Column:
    """Value of the first metadata entry whose field name holds a wanted word."""
    entries = F.transform(as_items(c), lambda item: F.from_json(item, _META))

    def pick(entry: Column) -> Column:
        value = first_non_empty(*[scalar(entry[f]) for f in ("value", "display_value", "displayValue")])

        def choose(name: Column) -> Column:
            ok = contains_any(name, wanted)
            if unwanted:
                ok = ok & ~contains_any(name, list(unwanted))
            return F.when(ok, value).otherwise("")

        return let(
            F.lower(first_non_empty(*[scalar(entry[f]) for f in ("name", "label", "key", "title")])), choose
        )

    return F.coalesce(F.get(filled_items(F.transform(entries, pick)), F.lit(0)), F.lit(""))


def category_metadata(c) -> Column:
    return metadata_value(c, rules.CATEGORY_FIELD_NAMES)


def job_type_metadata(c) -> Column:
    return metadata_value(c, rules.JOB_TYPE_FIELD_NAMES, ("location",))


def id_name_map(facets) -> Column:
    """Id -> Name map of a facet list (array of structs); the last of a repeated id wins."""
    facets = F.filter(
        F.coalesce(col(facets), F.array()), lambda f: ~is_blank(f["Id"]) & ~is_blank(f["Name"])
    )
    return last_wins(F.transform(facets, lambda f: F.named_struct(F.lit("k"), F.lower(f["Id"]), F.lit("v"), f["Name"])))


def positional(fields, values) -> Column:
    """Map of lower-cased field names to the values at the same positions."""
    n = F.least(F.size(fields), F.size(values))
    names_ = F.transform(F.slice(col(fields), 1, n), lambda f: F.lower(F.coalesce(f, F.lit(""))))
    pairs = zipped(names_, F.slice(col(values), 1, n), ("k", "v"))
    return last_wins(F.filter(pairs, lambda p: p["k"] != ""))


def translation(translations, field: str) -> Column:
    """Text of the English translation, or of the first language that has one."""
    translations = col(translations)
    pick = lambda v: keep_if_filled(scalar(F.get_json_object(v, f"$.{field}")))
    others = F.filter(F.transform(F.map_values(translations), pick), lambda v: v.isNotNull())
    return F.coalesce(pick(F.try_element_at(translations, F.lit("en"))), F.get(others, F.lit(0)))


def sections_text(sections, strip) -> Column:
    """Titled sections (map of name -> {title, text}) as 'title\\ntext' blocks."""
    parts = F.transform(
        F.map_values(col(sections)),
        lambda s: F.when(
            ~is_blank(strip(s["text"])),
            F.concat_ws("\n", keep_if_filled(s["title"]), strip(s["text"])),
        ),
    )
    return F.array_join(F.filter(parts, lambda p: p.isNotNull()), "\n\n")


def compensation(c) -> Column:
    """Pay summary: a string, a known summary field, or the JSON text of the object."""
    c = col(c)
    summary = F.coalesce(
        *[
            keep_if_filled(scalar(F.get_json_object(c, f"$.{f}")))
            for f in (
                "compensationTierSummary", "scrapeableCompensationSalarySummary",
                "summary", "description", "display",
            )
        ]
    )
    return F.when(c.rlike(r"^\s*\{"), F.coalesce(summary, c)).otherwise(c)
