"""Accounts as formulas over accounts (D7, D9 and the pivot chain R3 -> derive -> R4).

A formula is a signed sum of accounts, base or derived, with a stated rule for missing parts.
Formulas are ordered by what they depend on and evaluated in one aggregate; no row is
pivoted, joined or shuffled for the second time."""

from __future__ import annotations

import dataclasses
import functools
from collections.abc import Mapping, Sequence
from graphlib import CycleError, TopologicalSorter
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pnlflow import rules
from pnlflow.functions import scalars as S


@dataclasses.dataclass(frozen=True)
class Formula:
    """``name`` = sum of sign * account.  ``missing``: a NULL part makes the result NULL ("null"), or
    counts as zero ("zero")."""

    name: str
    parts: Mapping[str, int]
    missing: Literal["null", "zero"] = "null"


def job_formulas(missing: Literal["null", "zero"], shown: bool = False, lower: bool = False) -> list[Formula]:
    """The job's derived accounts over amounts in the source systems' signs, or in the signs of the result
    (``shown``); account names in upper or lower case."""
    name = str.lower if lower else str
    return [Formula(name(a), {name(p): -1 if shown and p in rules.SHOWN_NEGATED else 1 for p in parts}, missing)
            for a, parts in rules.DERIVED_ACCOUNTS.items()]


def ordered(formulas: Sequence[Formula]) -> list[Formula]:
    """Each formula after those it uses.  A cycle, or two formulas of one name, is an error."""
    by_name = {f.name: f for f in formulas}
    if len(by_name) < len(formulas):
        raise ValueError("an account has two formulas: " + ", ".join(sorted(f.name for f in formulas)))
    try:
        names = TopologicalSorter({f.name: [p for p in f.parts if p in by_name] for f in formulas}).static_order()
        return [by_name[n] for n in names]
    except CycleError as e:
        raise ValueError("accounts depend on each other: " + " -> ".join(e.args[1])) from e


def base_accounts(formulas: Sequence[Formula]) -> list[str]:
    """The accounts that are parts and no results, in the order of their first use."""
    made = {f.name for f in formulas}
    return list(dict.fromkeys(p for f in ordered(formulas) for p in f.parts if p not in made))


def evaluate(formulas: Sequence[Formula], known: Mapping[str, Column]) -> dict[str, Column]:
    """One column per formula over the columns of the base accounts."""
    at = dict(known)
    for f in ordered(formulas):
        if absent := [p for p in f.parts if p not in at]:
            raise ValueError(f"{f.name}: no account {', '.join(absent)}")
        part = S.zero_if_null if f.missing == "zero" else S.col
        terms = [part(at[p]) if sign == 1 else S.negate(part(at[p])) for p, sign in f.parts.items()]
        at[f.name] = functools.reduce(Column.__add__, terms)
    return {f.name: at[f.name] for f in formulas}


def derive_long(df: DataFrame, keys: Sequence[str], label: str, values: Sequence[str], formulas: Sequence[Formula],
                keep: Sequence[str] | None = None) -> DataFrame:
    """Rows of the derived accounts ``keep`` (default: all), one for each combination of ``keys``: each
    of ``values`` is derived on its own from the sums of the account rows of that combination.  A row exists
    if any of its values does; the others are 0 in it."""
    wanted = list(keep) if keep is not None else [f.name for f in formulas]
    base = {a: i for i, a in enumerate(base_accounts(formulas))}
    sums = df.groupBy(*keys).agg(*[F.sum(F.when(F.col(label) == F.lit(a), F.col(v))).alias(f"__a{i}_{v}") for a, i in base.items() for v in values])
    made = {v: evaluate(formulas, {a: F.col(f"__a{i}_{v}") for a, i in base.items()}) for v in values}
    rows = [F.struct(F.lit(a).alias(label), *[made[v][a].alias(v) for v in values]) for a in wanted]
    some = functools.reduce(Column.__or__, [F.col(f"__row.{v}").isNotNull() for v in values])
    return (sums.select(*keys, F.explode(F.array(*rows)).alias("__row")).where(some)
            .select(*keys, F.col(f"__row.{label}").alias(label), *[S.zero_if_null(f"__row.{v}").alias(v) for v in values]))
