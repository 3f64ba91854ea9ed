from __future__ import annotations

import pytest

from storefront_analytics.operators.quality import ROW_KINDS, Range, Rules, check_counts, key_check_counts
from storefront_analytics.plans.quality_rules import RULES, all_checks
from storefront_analytics.plans.storefront import Storefront
from storefront_analytics.queries import open_storefront
from tests.conftest import rows

T = Rules(
    keys=["id"],
    amounts=["amount"],
    shares=["share"],
    labels={"label": ("a", "b")},
    accepted={"flag": (True,)},
    ranges={"positive": Range(low=0, inclusive=False)},
    parents={"parent_id": ("parents", "id")},
    unique_together=[("label", "flag")],
    expressions=["amount >= positive"],
)
SCHEMA = "id int, amount double, share double, label string, flag boolean, positive int, parent_id int"
GOOD = [(1, 1.0, 0.0, "a", True, 1, 1), (2, 5.0, 1.0, "b", True, 5, None)]
BAD = [
    (1, -1.0, 1.5, "x", False, 0, 9),
    (1, None, -0.1, "x", False, 2, 9),
    (None, 1.0, None, None, None, None, 1),
]


@pytest.mark.parametrize("data, clean", [(GOOD, True), (BAD, False)])
def test_each_kind(spark, data, clean):
    relations = {"t": spark.createDataFrame(data, SCHEMA), "parents": spark.createDataFrame([(1,)], "id int")}
    got = {(r["subject"], r["check"]): r["violations"] for r in rows(check_counts(relations, T.checks("t")))}
    assert len(got) == len(T.checks("t"))
    if clean:
        assert set(got.values()) == {0}
        return
    assert got == {
        ("id", "unique"): 1,
        ("id", "not_null"): 1,
        ("amount", "not_null"): 1,
        ("share", "not_null"): 1,
        ("label", "not_null"): 1,
        ("label", "accepted_values"): 2,
        ("flag", "accepted_values"): 2,
        ("amount", "accepted_range"): 1,
        ("share", "accepted_range"): 2,
        ("positive", "accepted_range"): 1,
        ("parent_id", "relationships"): 2,
        ("label, flag", "unique_combination"): 1,
        ("amount >= positive", "expression_is_true"): 1,
    }


def test_declared_checks():
    checks = all_checks()
    kinds = {k: sum(c.kind == k for c in checks) for k in {c.kind for c in checks}}
    # The history's second declaration repeats 1 unique and 5 not_null checks,
    # which are stated once here.
    assert kinds == {
        "unique": 17,
        "not_null": 118,
        "accepted_values": 16,
        "relationships": 12,
        "accepted_range": 45,
        "expression_is_true": 1,
        "unique_combination": 3,
    }
    assert all(hasattr(Storefront, name) for name in RULES)


def test_key_rules_of_a_relation_move_it_once(spark):
    frame = spark.range(50, numPartitions=3).selectExpr(
        "id", "id % 7 as parent_id", "cast(id % 2 as string) as label", "id % 3 = 0 as flag", "id % 5 as other_id"
    )
    rules = Rules(
        keys=["id", "label"],
        parents={"parent_id": ("parents", "id"), "other_id": ("others", "key")},
        unique_together=[("label", "flag"), ("id", "label")],
    )
    relations = {"t": frame, "parents": spark.range(0, 5), "others": spark.createDataFrame([(0,), (0,), (4,), (None,)], "key int")}
    counts = key_check_counts(relations, [c for c in rules.checks("t") if c.kind not in ROW_KINDS])
    plan = counts._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.split("\n") if "Exchange hashpartitioning(rule" in line]
    assert len(moved) == 2  # the relation's keys, and the parents'
    got = {(r["subject"], r["check"]): r["violations"] for r in rows(counts)}
    assert got == {
        ("id", "unique"): 0,
        ("label", "unique"): 2,
        ("parent_id", "relationships"): 14,
        ("other_id", "relationships"): 30,
        ("label, flag", "unique_combination"): 4,
        ("id, label", "unique_combination"): 0,
    }
    assert rows(key_check_counts({**relations, "t": frame.filter("id < 0")}, [c for c in rules.checks("t") if c.kind == "unique"]))[0]["violations"] == 0


def test_whole_numbers_move_as_longs_without_a_join(spark):
    frame = spark.createDataFrame([(1, 1), (1, 9), (2, 9), (None, None), (None, None)], "id int, parent_id bigint")
    rules = Rules(keys=["id"], parents={"parent_id": ("parents", "id")})
    relations = {"t": frame, "parents": spark.createDataFrame([(1,), (1,), (None,)], "id int")}
    counts = key_check_counts(relations, [c for c in rules.checks("t") if c.kind not in ROW_KINDS])
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "as string" not in plan
    assert {r["check"]: r["violations"] for r in rows(counts)} == {"unique": 1, "relationships": 2}


def test_parents_of_another_type_are_compared_as_texts(spark):
    relations = {
        "t": spark.createDataFrame([(1,), (2,), (None,)], "parent_id int"),
        "parents": spark.createDataFrame([("1",), ("02",), (None,)], "id string"),
    }
    checks = Rules(parents={"parent_id": ("parents", "id")}).checks("t")
    assert [r["violations"] for r in rows(key_check_counts(relations, checks))] == [1]


def test_checks_leave_the_relations_whole(spark):
    store_ = open_storefront(spark, "/root/testdata/sf0.001")
    assert {r["violations"] for r in rows(store_.quality("unique_combination"))} >= {0}
    store_.quality("unique")
    assert "distinct_product_count" in store_.int_customer_orders.columns
