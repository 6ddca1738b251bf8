"""Scalar text functions as Column expressions (NAME, CLEAN, HDRROW, SPLIT)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STRIP = r"(?U)^\s+|\s+$"
# Noise deleted from section text, in this order.
NOISE = (r"(?U)\[\w+ Top\]", r"\[Table of Contents\]", r"\[Data_Table_start\].*?\[Data_Table_end\]", "Click here to view")
NUMBER = r"(?U)^\s*(?:[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|[+-]?[iI][nN][fF](?:[iI][nN][iI][tT][yY])?)\s*$"


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, STRIP, "")


def safe_name(text: Column) -> Column:
    """NAME-1: anything but letters, digits, dash and underscore becomes one; 50 characters at most."""
    return F.substring(F.regexp_replace(text, r"[^\p{L}\p{N}_-]", "_"), 1, 50)


def clean_section(text: Column) -> Column:
    """CLEAN-1."""
    out = stripped(F.regexp_replace(text, r"(?U)\s+", " "))
    for noise in NOISE:
        out = F.regexp_replace(out, noise, "")
    return out


def has_header_row(rows: Column) -> Column:
    """HDRROW-1: more than one row, and a first row that is not all numbers."""
    return (F.size(rows) > 1) & ~F.forall(F.get(rows, F.lit(0)), lambda c: c.rlike(NUMBER))


def split_row(line: Column) -> Column:
    """SPLIT-1: cells by bars, else by runs of white space, else by commas, else none."""
    full = lambda cells: F.filter(F.transform(cells, stripped), lambda c: c != "")
    bars = full(F.split(line, r"\|"))
    spaced = F.split(stripped(line), r"(?U)\s{2,}")
    commas = F.transform(F.split(line, ",", -1), stripped)
    none = F.array().cast("array<string>")
    return F.when(F.contains(line, F.lit("|")), bars).when(F.size(spaced) > 1, full(spaced)).when(F.size(F.split(line, ",", -1)) > 2, commas).otherwise(none)
