"""Catalogue of queries: each holds its DataFrame form and, where SQL can say it, the check SQL."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from .bindings import Inputs, with_bindings
from ..session import tune


def nudge(digits: int) -> float:
    """Moves exact halves off the rounding edge, where the two engines may differ."""
    return float(f"3e{-(digits + 4)}")


@dataclass
class Entry:
    build: Callable[[Inputs], DataFrame]
    check: str | None = None
    digits: dict[str, int] = field(default_factory=dict)

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        df = self.build(Inputs(tune(spark), folder))
        if not self.digits:
            return df
        return df.withColumns({c: F.round(F.col(c) + nudge(d), d) + F.lit(0.0) for c, d in self.digits.items()})

    def check_sql(self) -> str | None:
        if self.check is None:
            return None
        body = self.check
        if self.digits:
            swaps = ", ".join(f"round({c} + cast({nudge(d)!r} as double), {d}) + 0.0 as {c}" for c, d in self.digits.items())
            body = f"select * replace ({swaps}) from ({body.strip()})"
            inner = self.check.strip()
            if inner.lower().startswith("with "):
                # keep the leading WITH outermost so that bindings can be put in front of it
                head, tail = split_with(inner)
                body = f"{head} select * replace ({swaps}) from ({tail})"
        return strip_marker(with_bindings(body))


def split_with(sql: str) -> tuple[str, str]:
    """Split a check written as ``with ... --main-- select ...`` at its marker."""
    head, _, tail = sql.partition("--main--")
    return head, tail


REGISTRY: dict[str, Entry] = {}


def query(name: str, check: str | None = None, round: dict[str, int] | None = None):
    """Register a builder under ``name``; ``round`` gives the decimals compared per column."""

    def register(build: Callable[[Inputs], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Entry(build, check, dict(round or {}))
        return build

    return register


def strip_marker(sql: str) -> str:
    return re.sub(r"--main--", "", sql)
