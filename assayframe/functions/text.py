"""Text columns: keys, names and file names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def trimmed(x: Column | str) -> Column:
    return F.trim(_col(x))


def split_peak_key(key: Column | str) -> tuple[Column, Column]:
    """``mz__rt`` into two doubles; a malformed key gives nulls."""
    parts = F.split(_col(key), "__")
    return F.get(parts, 0).try_cast("double"), F.get(parts, 1).try_cast("double")


def strip_name(x: Column | str) -> Column:
    """Everything before the first ``.`` or ``;``."""
    return F.regexp_replace(_col(x), "(?s)[.;].*", "")


def strip_prefix(x: Column | str, prefix: str = "path:") -> Column:
    return F.replace(_col(x), F.lit(prefix), F.lit(""))


def file_stem(path: Column | str, suffix: str) -> Column:
    """Base name of a path without a fixed suffix."""
    name = F.element_at(F.split(_col(path), "/"), -1)
    cut = F.substring(name, F.lit(1), F.length(name) - len(suffix))
    return F.when(F.endswith(name, F.lit(suffix)), cut).otherwise(name)


def ratio_text(k: Column | str, n: Column | str) -> Column:
    """``k/n`` as text."""
    return F.concat_ws("/", _col(k).cast("string"), _col(n).cast("string"))


def first_of(values: Column | str) -> Column:
    """First element of a list, null for an empty one."""
    return F.get(_col(values), 0)


def search_key(name: Column | str) -> Column:
    """Name folded for a free-text search: lower case, single blanks, no outer blanks."""
    return F.trim(F.regexp_replace(F.lower(_col(name)), r"\s+", " "))
