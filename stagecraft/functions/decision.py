"""First-match decision tables expanded into one struct-valued CASE.

A table is written once as rows of (condition, outcome); every outcome is a
dict with the same keys. ``decide`` turns it into a single SQL ``CASE WHEN``
that returns a ``named_struct``, so each condition is evaluated once per row
instead of once per output column, the table reads like the specification, and
the whole table is parsed by Spark in one call.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any


class Sql(str):
    """An outcome value that is a SQL expression, not a literal."""


def _value(v: Any, dtype: str) -> str:
    if v is None:
        return f"CAST(NULL AS {dtype})"
    if isinstance(v, Sql):
        return f"CAST({v} AS {dtype})"
    if isinstance(v, str):
        escaped = v.replace("'", "\\'")
        return f"CAST('{escaped}' AS {dtype})"
    return f"CAST({v!r} AS {dtype})"


def decide(
    rules: Sequence[tuple[str, Mapping[str, Any]]],
    default: Mapping[str, Any],
    types: Mapping[str, str],
) -> str:
    """SQL ``CASE`` giving the outcome struct of the first rule whose condition is true.

    Conditions are SQL predicates; an unknown (NULL) predicate does not match.
    ``types`` fixes the type of each field; a rule may omit a field, which then
    takes the default's value.
    """

    def outcome(values: Mapping[str, Any]) -> str:
        fields = ", ".join(f"'{n}', {_value(values.get(n, default.get(n)), t)}" for n, t in types.items())
        return f"named_struct({fields})"

    whens = " ".join(f"WHEN {cond} THEN {outcome(values)}" for cond, values in rules)
    return f"CASE {whens} ELSE {outcome(default)} END"
