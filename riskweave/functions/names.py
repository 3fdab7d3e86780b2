"""Column-name operators (P6-P8, P13, U2, F21). Names are driver metadata;
no row data moves."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from itertools import chain, count

from pyspark.sql import DataFrame

#: What a cleaned name replaces, and its prefix before a digit (fixed values).
REPLACED = re.compile(r"\s+|[^\w\s]")
DIGIT_PREFIX = "f_"


def clean_name(name: str) -> str:
    """Every run of blanks and every other non-word character becomes '_'; no name starts with a digit."""
    clean = REPLACED.sub("_", name)
    return DIGIT_PREFIX + clean if clean[:1].isdigit() else clean


def clean_names(columns: Sequence[str], target: str | None = None) -> tuple[list[str], dict[str, str]]:
    """Cleaned names in column order, and original -> cleaned without the target.

    Names are handed out once: of columns that clean to the same name the first
    gets it, the others its first free number (``_1``, ``_2`` ...). The target's
    name is its own and is not handed out.
    """
    owner: dict[str, str] = {target: target} if target in columns else {}

    def hand_out(column: str) -> str:
        base = clean_name(column)
        free = next(n for n in chain([base], (f"{base}_{k}" for k in count(1))) if n not in owner)
        owner[free] = column
        return free
    names = [c if c == target else hand_out(c) for c in columns]
    return names, {column: name for name, column in owner.items() if column != target}


def clean_feature_names(df: DataFrame, target: str | None = None) -> tuple[DataFrame, dict[str, str]]:
    names, mapping = clean_names(df.columns, target)
    return df.toDF(*names), mapping


def revert_names(names: Iterable[str], mapping: Mapping[str, str]) -> list[str]:
    """Cleaned -> original; of originals with one cleaned name the first in the mapping."""
    original = {new: old for old, new in reversed(mapping.items())}
    return [original.get(n, n) for n in names]


def rename_by_map(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename what exists; absent names are skipped."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def schema_diff(left: DataFrame, right: DataFrame) -> list[tuple[str, str | None, str | None]]:
    """(column, left type, right type) over the union of names,
    left columns first in order, then right-only columns."""
    lt = dict(left.dtypes)
    rt = dict(right.dtypes)
    names = list(lt) + [c for c in rt if c not in lt]
    return [(c, lt.get(c), rt.get(c)) for c in names]
