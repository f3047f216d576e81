"""Posting references: tenant-scoped hashes and the reference ladder."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from jobweave import rules
from jobweave.functions.text import col, is_blank, trim_ws
from jobweave.functions.url import tenant_key


def _digest(text: Column) -> Column:
    return F.left(F.sha2(F.lower(text).cast("binary"), 256), F.lit(32))


def scoped_id(source_id: int, source_key: str, domain, raw_id) -> Column:
    """'<source id>:h' + 32 hex digits over source|tenant|id."""
    raw = F.coalesce(trim_ws(raw_id), F.lit(""))
    return F.concat(F.lit(f"{source_id}:h"), _digest(F.concat_ws("|", F.lit(source_key), tenant_key(domain), raw)))


def site_scoped_id(source_id: int, domain, site, raw_id) -> Column:
    """The form keyed on domain|site|id."""
    return F.concat(
        F.lit(f"{source_id}:h"),
        _digest(F.concat_ws("|", *[F.coalesce(col(c), F.lit("")) for c in (domain, site, raw_id)])),
    )


def plain_id(source_id: int, raw_id) -> Column:
    return F.concat(F.lit(f"{source_id}:"), col(raw_id))


def generated_reference(domain, tenant, site, external_path, title) -> Column:
    parts = [F.coalesce(col(c), F.lit("")) for c in (domain, tenant, site, external_path, title)]
    return F.concat(F.lit("workday:h"), _digest(F.concat_ws("|", *parts)))


def looks_like_reference(c) -> Column:
    """No space or slash, at least one digit."""
    text = trim_ws(c)
    return F.coalesce(~text.rlike("[ /]") & text.rlike("[0-9]"), F.lit(False))


def reference_from_path(external_path) -> Column:
    leaf = F.split_part(F.rtrim(trim_ws(F.coalesce(col(external_path), F.lit(""))), F.lit("/")), F.lit("/"), F.lit(-1))
    return F.regexp_extract(leaf, rules.REFERENCE_IN_PATH, 1)


def reference_from_text(c) -> Column:
    return F.regexp_extract(F.coalesce(col(c), F.lit("")), rules.REFERENCE_IN_TEXT, 1)


def workday_reference(req_id, category, external_path, domain, tenant, site, title) -> Column:
    """First usable of: requisition id, category, path ending, id inside the category;
    otherwise a generated reference."""
    ladder = [col(req_id), col(category), reference_from_path(external_path), reference_from_text(category)]
    return F.coalesce(
        *[F.when(looks_like_reference(c), trim_ws(c)) for c in ladder],
        generated_reference(domain, tenant, site, external_path, title),
    )


def prefer_detail_reference(current, detail) -> Column:
    """The detail page's reference replaces a blank or generated one."""
    replaceable = is_blank(current) | F.startswith(F.lower(trim_ws(current)), F.lit("workday:h"))
    return F.when(looks_like_reference(detail) & replaceable, trim_ws(detail)).otherwise(col(current))
