"""Column-name normalisers and text cleaning expressions (JVM-side built-ins only)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def snake_case(name: str) -> str:
    """Lower-case; space, hyphen and slash become underscores ('Sub-channel' -> 'sub_channel')."""
    out = name.lower()
    for ch in (" ", "-", "/"):
        out = out.replace(ch, "_")
    return out


def snake_case_strict(name: str) -> str:
    """Strip and lower-case, drop every non-word non-space character, join word runs with '_'."""
    out = re.sub(r"[^\w\s]", "", name.strip().lower())
    return re.sub(r"\s+", "_", out)


# ISO 3166 codes and the country names they stand for.
COUNTRY_NAMES = {
    "AR": "Argentina", "BR": "Brazil", "CA": "Canada", "CN": "China", "DE": "Germany", "DZ": "Algeria", "EG": "Egypt",
    "ES": "Spain", "ET": "Ethiopia", "FR": "France", "GB": "United Kingdom", "ID": "Indonesia", "IN": "India", "IQ": "Iraq",
    "IR": "Iran", "IT": "Italy", "JO": "Jordan", "JP": "Japan", "KE": "Kenya", "MA": "Morocco", "MZ": "Mozambique", "PE": "Peru",
    "PL": "Poland", "PT": "Portugal", "RO": "Romania", "RU": "Russia", "SA": "Saudi Arabia", "US": "United States", "VN": "Vietnam",
}


def country_name(c: Column | str) -> Column:
    """The name of a two-letter country code in either case; other texts stay as they are."""
    c = F.col(c) if isinstance(c, str) else c
    names = F.create_map(*[F.lit(x) for pair in COUNTRY_NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(names, F.upper(F.trim(c))), c)


def normalize_columns(df: DataFrame, strict: bool = False) -> DataFrame:
    """Rename every column in ONE projection (no chain of withColumnRenamed)."""
    fn = snake_case_strict if strict else snake_case
    return df.toDF(*[fn(c) for c in df.columns])


def _case(c: Column, style: str) -> Column:
    if style == "upper":
        return F.upper(c)
    if style == "lower":
        return F.lower(c)
    if style == "initcap":
        return F.initcap(c)
    if style == "none":
        return c
    raise ValueError(f"unknown text style {style!r}")


def collapse_space(c: Column) -> Column:
    """Every run of white space as one space; texts without such a run, most of them, are spared the regular expression."""
    odd = c.contains("  ") | c.rlike(r"[\t-\r]")  # two tests: one for each kind of space took several times as long
    return F.when(odd, F.regexp_replace(c, r"\s+", " ")).otherwise(c)


def clean_text(c: Column | str, style: str = "initcap") -> Column:
    """Collapse whitespace runs to one space, trim, then apply the case style."""
    c = F.col(c) if isinstance(c, str) else c
    return _case(F.trim(collapse_space(c)), style)


def trim_case(c: Column | str, style: str = "initcap") -> Column:
    """Trim and apply the case style without collapsing inner whitespace."""
    c = F.col(c) if isinstance(c, str) else c
    return _case(F.trim(c), style)


def clean_columns(df: DataFrame, plan: dict[str, str], collapse: bool = True) -> DataFrame:
    """Apply a {column: style} plan in a single projection."""
    fn = clean_text if collapse else trim_case
    return df.withColumns({c: fn(c, s) for c, s in plan.items() if c in df.columns})
