"""Text helpers: fallback chains, previews, names of files, ids, natural order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_text(*columns: Column, default: Column | str | None = None) -> Column:
    """The first that is neither null nor empty."""
    last = [] if default is None else [F.lit(default) if isinstance(default, str) else default]
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in columns), *last)


def json_text(document: Column, *keys: str, default: str | None = "") -> Column:
    """The first of a JSON document's keys that holds a non-empty string; other types don't count."""
    def string(key: str) -> Column:
        value = F.try_variant_get(document, f"$.{key}", "variant")
        return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(document, f"$.{key}", "string"))

    return first_text(*(string(k) for k in keys), default=default)


def preview(text: Column, size: int = 60) -> Column:
    """One line of at most size characters."""
    return F.substring(F.regexp_replace(text, "\n", " "), 1, size)


def base_name(path: Column) -> Column:
    """The last segment of a path; slashes at its end don't count."""
    return F.regexp_extract(F.regexp_replace(path, "/+$", ""), "[^/]*$", 0)


def triple_id(a: Column, b: Column, c: Column) -> Column:
    return F.concat_ws("_", a.cast("string"), b.cast("string"), c.cast("string"))


def split_triple(identifier: Column, part: int) -> Column:
    """Part 1, 2 or 3 of an id as a number; null where it has fewer parts."""
    return F.try_element_at(F.split(identifier, "_"), F.lit(part)).try_cast("long")


def range_label(first: Column, last: Column) -> Column:
    """a, or a-b."""
    return F.when(first == last, first.cast("string")).otherwise(F.concat_ws("-", first.cast("string"), last.cast("string")))


def natural_key(name: Column, width: int = 12) -> Column:
    """A text that sorts as name does when runs of digits count as numbers."""
    parts = F.regexp_extract_all(name, F.lit(r"\d+|\D+"), F.lit(0))
    padded = F.transform(parts, lambda p: F.when(p.rlike(r"^\d"), F.lpad(F.regexp_replace(p, "^0+(?=.)", ""), width, "0")).otherwise(p))
    return F.array_join(padded, "")


def fill(template: Column | str, **values: Column) -> Column:
    """The template with each {name} replaced by its value."""
    out = F.lit(template) if isinstance(template, str) else template
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return out
