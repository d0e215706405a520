"""Identity keys: file names, slugs, fingerprints, ids and normal forms of routes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def present(*cols: Column | str) -> Column:
    """The first of several key variants that is neither null nor empty."""
    return F.coalesce(*[F.nullif(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in cols])


def basename(path: Column | str) -> Column:
    """Last part of a path in lower case, the usual join key for files."""
    return F.lower(F.regexp_extract(path, r"([^/]+)/*$", 1))


def slug(kind: Column | str, label: Column | str) -> Column:
    """``kind:label`` with the label in lower case and other signs as underscores, trimmed."""
    clean = F.regexp_replace(F.lower(F.trim(label)), r"[^a-z0-9_]", "_")
    return F.concat(kind, F.lit(":"), F.trim(clean, F.lit("_")))


def fingerprint(category: Column, context: Column, description: Column) -> Column:
    """First eight hex digits of the md5 of the parts joined by bars."""
    return F.substring(F.md5(F.concat_ws("|", category, context, F.lower(description))), 1, 8)


def cache_key(*parts: Column | str) -> Column:
    return F.sha2(F.concat_ws("\0", *parts), 256)


def normal_route(path: Column | str) -> Column:
    """Parametric, numeric and UUID segments become ``{*}``, in this order; no trailing slash."""
    out = F.regexp_replace(path, r"\{[^/}]+\}", "{*}")
    out = F.regexp_replace(out, r"(?<=/):[A-Za-z_][A-Za-z0-9_]*", "{*}")
    out = F.regexp_replace(out, r"(?<=/)[0-9]+(?=/|$)", "{*}")
    out = F.regexp_replace(out, r"(?i)(?<=/)[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}(?=/|$)", "{*}")
    return F.when(out.isin("", "/"), "/").otherwise(F.regexp_replace(out, r"/+$", ""))


def numbered(df: DataFrame, pattern: str, order: list, name: str = "id") -> DataFrame:
    """Sequential ids such as ``BR-001`` over an explicit total order.

    Numbers without gaps need one global order; use this on result-sized tables.
    """
    return df.withColumn(name, F.format_string(pattern, F.row_number().over(Window.orderBy(*order))))


def snake(name: Column | str) -> Column:
    return F.lower(F.regexp_replace(F.regexp_replace(name, r"([a-z0-9])([A-Z])", "$1_$2"), r"[\s-]+", "_"))


def plural(name: Column) -> Column:
    """``y`` after a consonant to ``ies``; ``es`` after a hiss; else ``s``."""
    return (
        F.when(name.rlike(r"[^aeiou]y$"), F.regexp_replace(name, r"y$", "ies"))
        .when(name.rlike(r"(s|x|z|ch|sh)$"), F.concat(name, F.lit("es")))
        .otherwise(F.concat(name, F.lit("s")))
    )


def human(name: Column | str) -> Column:
    """Words of a snake or camel name, each with a capital first letter and the rest in lower case."""
    words = F.filter(F.split(F.regexp_replace(snake(name), r"[_\s]+", " "), " "), lambda w: w != "")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))), " ")
