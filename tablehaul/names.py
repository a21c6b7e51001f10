"""Quoted identifiers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, functions as F


def quoted(name: str, quote: str = "`") -> str:
    return quote + name.replace(quote, quote * 2) + quote


def column(name: str) -> Column:
    return F.col(quoted(name))


def columns(names: Sequence[str]) -> list[Column]:
    return [column(n) for n in names]


def unused(taken: Iterable[str], *wanted: str) -> list[str]:
    """Names like the wanted ones that are not taken; Spark does not tell upper from lower case."""
    known = {t.lower() for t in taken}
    out = []
    for name in wanted:
        while name.lower() in known:
            name += "_"
        known.add(name.lower())
        out.append(name)
    return out
