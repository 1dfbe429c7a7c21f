"""Typed cells and inline formats of delimited files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clonespark.functions.dna import _col


def is_int(cell: Column | str) -> Column:
    return F.trim(_col(cell)).try_cast("bigint").isNotNull() & F.trim(_col(cell)).rlike(r"^[+-]?\d+$")


def typed(cell: Column | str) -> Column:
    """A cell as (kind, long, double, bool, string): the first of integer, float, boolean, none and string that it reads as.

    Quotes are removed. Integers have no leading zeros; NULL is the string None, as files have it.
    """
    s = F.regexp_replace(_col(cell), "[\"']", "")
    whole = s.rlike(r"^[+-]?(0+|[1-9]\d*)$") & s.try_cast("bigint").isNotNull()
    real = s.rlike(r"^[+-]?(\d+\.\d*|\.\d+|\d+)([eE][+-]?\d+)?$") & s.rlike(r"[.eE]")
    kind = F.when(whole, "int").when(real, "float").when(s.isin("True", "False"), "bool").when(s == "None", "none").otherwise("str")
    return F.struct(
        kind.alias("kind"),
        F.when(whole, s.try_cast("bigint")).alias("long"),
        F.when(real, s.try_cast("double")).alias("double"),
        F.when(s.isin("True", "False"), s == "True").alias("bool"),
        F.when(kind == "str", F.when(s == "NULL", F.lit("None")).otherwise(s)).alias("string"),
    )


def without_formats(cell: Column | str) -> Column:
    """A cell's text without its {key:value} fragments."""
    return F.regexp_replace(_col(cell), r"\{[^{}]*\}", "")


def formats(cell: Column | str) -> Column:
    """The {key:value} fragments of a cell as a map; a key given twice keeps its last value."""
    found = F.regexp_extract_all(_col(cell), F.lit(r"\{([^{}:]*):[^{}]*\}"), 1)
    values = F.regexp_extract_all(_col(cell), F.lit(r"\{[^{}:]*:([^{}]*)\}"), 1)
    pairs = F.arrays_zip(found.alias("k"), values.alias("v"))
    last = F.filter(F.transform(pairs, lambda p, i: F.struct(p["k"].alias("k"), p["v"].alias("v"), i.alias("i"))), lambda p: F.array_position(F.slice(found, p["i"] + 2, F.greatest(F.size(found), F.lit(1))), p["k"]) == 0)
    return F.map_from_entries(F.transform(last, lambda p: F.struct(p["k"], p["v"])))


def or_na(cell: Column | str, na: str = "N/A") -> Column:
    """The cell as a string, na for null: for sinks."""
    return F.coalesce(_col(cell).cast("string"), F.lit(na))
