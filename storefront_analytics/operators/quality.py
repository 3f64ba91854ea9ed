"""Declarative checks: rules in, counts of violations out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from storefront_analytics.functions.columns import count_rows


@dataclass(frozen=True)
class Range:
    low: float | None = None
    high: float | None = None
    inclusive: bool = True


@dataclass(frozen=True)
class Check:
    """One rule on one relation; ``columns`` names its subject."""

    relation: str
    kind: str
    columns: tuple[str, ...]
    values: tuple = ()
    range: Range | None = None
    parent: tuple[str, str] | None = None
    expression: str | None = None

    @property
    def subject(self) -> str:
        return ", ".join(self.columns) if self.columns else str(self.expression)


@dataclass(frozen=True)
class Rules:
    """What a relation promises.

    ``keys`` are unique and filled, ``amounts`` filled and at least 0, ``shares``
    filled and within 0 and 1, ``labels`` filled and from a list; the other
    fields state a single check each.
    """

    keys: Sequence[str] = ()
    not_null: Sequence[str] = ()
    amounts: Sequence[str] = ()
    shares: Sequence[str] = ()
    labels: Mapping[str, Sequence] = field(default_factory=dict)
    accepted: Mapping[str, Sequence] = field(default_factory=dict)
    ranges: Mapping[str, Range] = field(default_factory=dict)
    parents: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    unique_together: Sequence[Sequence[str]] = ()
    expressions: Sequence[str] = ()

    def checks(self, relation: str) -> list[Check]:
        filled = [*self.keys, *self.not_null, *self.amounts, *self.shares, *self.labels]
        ranges = {
            **{c: Range(low=0) for c in self.amounts},
            **{c: Range(0, 1) for c in self.shares},
            **self.ranges,
        }
        return [
            *[Check(relation, "unique", (c,)) for c in self.keys],
            *[Check(relation, "not_null", (c,)) for c in filled],
            *[Check(relation, "accepted_values", (c,), values=tuple(v)) for c, v in self.labels.items()],
            *[Check(relation, "accepted_values", (c,), values=tuple(v)) for c, v in self.accepted.items()],
            *[Check(relation, "accepted_range", (c,), range=r) for c, r in ranges.items()],
            *[Check(relation, "relationships", (c,), parent=p) for c, p in self.parents.items()],
            *[Check(relation, "unique_combination", tuple(c)) for c in self.unique_together],
            *[Check(relation, "expression_is_true", (), expression=e) for e in self.expressions],
        ]


def violates(check: Check) -> Column:
    """Row condition of a rule that looks at one row at a time."""
    if check.kind == "expression_is_true":
        return ~F.expr(check.expression)
    value = F.col(check.columns[0])
    if check.kind == "not_null":
        return value.isNull()
    if check.kind == "accepted_values":
        return ~value.isin(*check.values)
    low, high, inclusive = check.range.low, check.range.high, check.range.inclusive
    below = F.lit(False) if low is None else (value < low if inclusive else value <= low)
    above = F.lit(False) if high is None else (value > high if inclusive else value >= high)
    return below | above


ROW_KINDS = ("not_null", "accepted_values", "accepted_range", "expression_is_true")


def _listed(counts: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row with a column v0, v1, ... per check as a row per check."""
    rows = [
        F.struct(
            F.lit(c.relation).alias("relation"),
            F.lit(c.subject).alias("subject"),
            F.lit(c.kind).alias("check"),
            F.col(f"v{i}").alias("violations"),
        )
        for i, c in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*rows)))


def row_check_counts(frame: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All row rules of one relation in a single pass over it."""
    return _listed(frame.agg(*[F.count_if(violates(c)).alias(f"v{i}") for i, c in enumerate(checks)]), checks)


def _whole_numbers(check: Check, relations: Mapping[str, DataFrame]) -> bool:
    """Whether the rule looks at one column of whole numbers, on the side of the parents, too."""
    subjects = [(check.relation, check.columns), *([(check.parent[0], check.parent[1:])] if check.parent else [])]
    return all(len(c) == 1 and isinstance(relations[name].schema[c[0]].dataType, IntegralType) for name, c in subjects)


def _keys(
    frame: DataFrame, keys: Sequence[tuple[int, Sequence[str]]], numbers: bool, with_null: Sequence[int] = (), known: bool = False
) -> DataFrame:
    """A row per rule and row: rule, key, known.

    The key is a long for rules on ``numbers``, else the columns as texts; null where it is missing, but for
    rules ``with_null``. ``known``: the rows are those of a parent.
    """

    def key(rule: int, columns: Sequence[str]) -> Column:
        first = F.col(columns[0])
        if numbers:
            return first.cast("bigint")
        texts = F.array(*[F.col(c).cast("string") for c in columns])
        return texts if rule in with_null else F.when(first.isNotNull(), texts)

    if len(keys) == 1:
        (rule, columns), = keys
        found = frame.select(F.lit(rule).alias("rule"), key(rule, columns).alias("key"))
    else:
        found = frame.select(F.inline(F.array(*[F.struct(F.lit(r).alias("rule"), key(r, c).alias("key")) for r, c in keys])))
    return found.withColumn("known", F.lit(known))


def key_check_counts(relations: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """All rules on keys of one relation: a scan and an exchange of its keys that are whole numbers, and one of the others.

    Whole numbers move as longs, other keys as texts, both combined before they move.
    """
    numbers = [c for c in checks if _whole_numbers(c, relations)]
    others = [c for c in checks if c not in numbers]
    parts = [_key_counts(relations, own, own is numbers) for own in (numbers, others) if own]
    return reduce(DataFrame.unionByName, parts)


def _key_counts(relations: Mapping[str, DataFrame], checks: Sequence[Check], numbers: bool) -> DataFrame:
    """Violations of rules on keys of one relation that are all whole numbers or all texts.

    A rule on a key counts the keys that repeat; a rule on parents counts the
    rows of the keys that no parent has. A key that most rows share is one row
    per task. Parents' keys are grouped with the children's, so nothing is joined.
    """
    frame = relations[checks[0].relation]
    together = [i for i, c in enumerate(checks) if c.kind == "unique_combination" and len(c.columns) > 1]
    parents = [(i, *c.parent) for i, c in enumerate(checks) if c.kind == "relationships"]
    keys = _keys(frame, [(i, c.columns) for i, c in enumerate(checks)], numbers, together)
    rows, more = count_rows(), []
    filled = F.col("key").isNotNull()  # missing keys are one group, which no rule counts
    repeated = F.when(filled & (F.col("rows") > 1), 1).otherwise(0).cast("bigint")
    violations = repeated
    if parents:
        known = [_keys(relations[name], [(i, (column,))], numbers, known=True) for i, name, column in parents]
        keys = reduce(DataFrame.unionByName, known, keys)
        rows = F.count_if(~F.col("known"))
        more = [F.bool_or("known").alias("with_parent")]
        orphans = F.when(F.col("with_parent") | ~filled, 0).otherwise(F.col("rows"))
        violations = F.when(F.col("rule").isin([i for i, *_ in parents]), orphans).otherwise(repeated)
    counted = keys.groupBy("rule", "key").agg(rows.alias("rows"), *more)
    sums = counted.withColumn("violations", violations).agg(
        *[F.coalesce(F.sum(F.when(F.col("rule") == i, F.col("violations"))), F.lit(0)).alias(f"v{i}") for i in range(len(checks))]
    )
    return _listed(sums, checks)


def check_counts(relations: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row per check: relation, subject, check, violations. A relation is read once for rows, once or twice for keys."""
    by_row: dict[str, list[Check]] = {}
    by_key: dict[str, list[Check]] = {}
    for c in checks:
        (by_row if c.kind in ROW_KINDS else by_key).setdefault(c.relation, []).append(c)
    parts = [row_check_counts(relations[name], own) for name, own in by_row.items()]
    parts += [key_check_counts(relations, own) for own in by_key.values()]
    return reduce(DataFrame.unionByName, parts)
