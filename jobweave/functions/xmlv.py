"""Values of XML elements."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from jobweave.functions.text import col


def xml_record(body, schema: str, row_tag: str) -> Column:
    """The child elements of an element as a struct; NULL fields where it can't be read.

    ``schema`` names the children; namespaces don't count.
    """
    return F.from_xml(col(body), schema, {"rowTag": row_tag, "ignoreNamespace": "true"})


def xml_elements(body, tag: str) -> Column:
    """Every element of this name as text, whatever it lies in."""
    pattern = rf"(?s)<{tag}\b[^>]*>.*?</{tag}>"
    return F.regexp_extract_all(F.coalesce(col(body), F.lit("")), F.lit(pattern), F.lit(0))
