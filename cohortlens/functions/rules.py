"""Rule-table building blocks: each turns a small table of (condition, output) data into
one JVM-side column expression (a CASE chain), so cleaning rules stay data and run
inside whole-stage codegen.  First matching rule wins everywhere."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def range_null_out(col: str | Column, low: float, high: float) -> Column:
    """Value when ``low <= value <= high`` (inclusive), else NULL."""
    c = _c(col)
    return F.when(c.between(low, high), c)


def coalesce_proxy(*cols: str | Column) -> Column:
    """First non-NULL of several answers to the same question."""
    return F.coalesce(*[_c(c) for c in cols])


def threshold_bins(value: Column, bins: Sequence[tuple[str, float]], last: tuple[str, float] | None = None) -> Column:
    """Label by upper bounds: ``value < bound`` for each (label, bound) in order; then
    ``value <= last_bound`` for the optional closed last bin; else NULL."""
    expr = None
    for label, bound in bins:
        expr = F.when(value < bound, F.lit(label)) if expr is None else expr.when(value < bound, F.lit(label))
    if last is not None:
        label, bound = last
        expr = expr.when(value <= bound, F.lit(label))
    return expr


@dataclass(frozen=True)
class PatternRule:
    """Output ``label`` when the text matches any ``like`` pattern (case-insensitive),
    or equals any ``exact`` value (case-sensitive), and matches no ``unless`` pattern."""

    label: object
    like: tuple[str, ...] = ()
    exact: tuple[str, ...] = ()
    unless: tuple[str, ...] = field(default=())

    def condition(self, c: Column) -> Column:
        hits = [c.ilike(p) for p in self.like] + [c == F.lit(v) for v in self.exact]
        cond = hits[0]
        for h in hits[1:]:
            cond = cond | h
        for p in self.unless:
            cond = cond & ~c.ilike(p)
        return cond


def pattern_labels(col: str | Column, rules: Sequence[PatternRule], default: object = None) -> Column:
    """Ordered ILIKE rules -> label (a searched CASE)."""
    c = _c(col)
    expr = None
    for r in rules:
        cond = r.condition(c)
        expr = F.when(cond, F.lit(r.label)) if expr is None else expr.when(cond, F.lit(r.label))
    if default is not None:
        expr = expr.otherwise(F.lit(default))
    return expr


def label_ordinal(col: str | Column, mapping: Mapping[str, int]) -> Column:
    """Exact label -> small ordinal (simple CASE), unknown labels NULL."""
    c = _c(col)
    expr = None
    for label, rank in mapping.items():
        expr = F.when(c == F.lit(label), F.lit(rank)) if expr is None else expr.when(c == F.lit(label), F.lit(rank))
    return expr


def first_token(col: str | Column, sep: str = ";") -> Column:
    """Text before the first separator; NULL stays NULL, '' stays '', no trimming."""
    return F.split_part(_c(col), F.lit(sep), F.lit(1))


def non_blank(col: str | Column, trimmed: bool = True) -> Column:
    """``IS NOT NULL AND TRIM(x) != ''`` (or the untrimmed ``!= ''`` variant)."""
    c = _c(col)
    return c.isNotNull() & ((F.trim(c) if trimmed else c) != F.lit(""))


# Whitespace as Python's str.strip() sees it: Unicode White_Space plus the
# information separators U+001C..U+001F.
_WS = r"[\s\x{1C}-\x{1F}]"


def strip_unicode(col: str | Column) -> Column:
    """Remove leading/trailing whitespace of any kind (tab, NBSP, ...), not only spaces."""
    return F.regexp_replace(_c(col), rf"(?U)^{_WS}+|{_WS}+$", "")
