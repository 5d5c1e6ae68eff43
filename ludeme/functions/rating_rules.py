"""Action -> rating rules as plain Column expressions (JVM-side, codegen'd).

A rule is a mapping ``action -> expression`` plus an ``otherwise`` expression
for every other action (including NULL and unknown ones), and an optional
``keep`` list that filters the log to the named actions first.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from ludeme.sources.schema import ACTION, PLAY, PURCHASE, VALUE


@dataclass(frozen=True)
class RatingRule:
    name: str
    per_action: dict = field(default_factory=dict)   # action -> Column factory
    otherwise: object = None                           # Column factory, None -> NULL
    keep: tuple | None = None                          # actions to keep, None -> all

    def expr(self) -> Column:
        out = None
        for action, make in self.per_action.items():
            cond = F.col(ACTION) == F.lit(action)
            out = F.when(cond, make()) if out is None else out.when(cond, make())
        other = self.otherwise() if self.otherwise is not None else F.lit(None)
        if out is None:
            return other.cast("double")
        return out.otherwise(other).cast("double")

    def unmapped(self) -> Column:
        """True for rows whose action no explicit entry names (they fall to
        ``otherwise``)."""
        if not self.per_action:
            return F.lit(True)
        return ~F.coalesce(F.col(ACTION).isin(*self.per_action), F.lit(False))


def _value() -> Column:
    return F.col(VALUE)


def _one() -> Column:
    return F.lit(1.0)


def _log1p_value() -> Column:
    # ln(1 + x); NULL for x <= -1
    return F.log1p(F.col(VALUE))


# Case 1: plays only, rating = hours.
PLAY_ONLY = RatingRule("play", per_action={PLAY: _value}, otherwise=None, keep=(PLAY,))
# Case 2: purchase -> 1.0, everything else -> raw value.
COMBINED = RatingRule("combined", per_action={PURCHASE: _one}, otherwise=_value)
# Case 3: purchase -> 1.0, everything else -> log1p(value).
COMBINED_LOG = RatingRule("log", per_action={PURCHASE: _one}, otherwise=_log1p_value)
# The explicit-feedback variant trains on the raw value of every action.
RAW_VALUE = RatingRule("raw", per_action={}, otherwise=_value)

RULES = {r.name: r for r in (PLAY_ONLY, COMBINED, COMBINED_LOG, RAW_VALUE)}
