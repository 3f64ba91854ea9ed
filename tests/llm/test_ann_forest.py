from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from storefront_analytics.llm.ann_forest import ForestConfig, fit_tree, nearest

SCHEMA = "rank int, vec_id long, embedding array<float>, leaf int, score string"


@pytest.fixture
def table(spark):
    def build(vectors):
        return spark.createDataFrame([(1, i, v, 2, "s") for i, v in vectors], SCHEMA).repartition(3)

    return build


def _brute(vectors, k=10):
    good = [
        (i, np.array(v, dtype=np.float32).astype(float))
        for i, v in vectors
        if i is not None and v is not None and len(v) == 3 and None not in v and np.isfinite(v).all() and any(v)
    ]
    found = {}
    for q, x in good:
        if q % 100 == 0:
            near = {}
            for i, v in good:
                if i != q:
                    near[i] = min(near.get(i, 9e9), float(np.sqrt(((v - x) ** 2).sum())))
            found[q] = sorted((s, i) for i, s in near.items())[:k]
    return found


def _got(frame):
    found = {}
    for r in frame.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(found[r.query_id])
    return found


def test_hard_cases_are_exact_when_all_is_visited(table):
    rng = np.random.default_rng(1)
    vectors = [(i, rng.normal(size=3).tolist()) for i in range(0, 260)]
    vectors += [(300 + i, [1.0, 2.0, 3.0]) for i in range(40)]  # ties
    vectors += [(500, None), (501, [0.0, 0.0, 0.0]), (502, [1.0, None, 2.0]), (503, [1.0, float("nan"), 2.0])]
    vectors += [(600, [1.0, float("inf"), 2.0]), (700, [1.0, 2.0]), (None, [1.0, 1.0, 1.0]), (5, [9.0, 9.0, 9.0])]
    got = _got(nearest(table(vectors), F.col("vec_id") % 100 == 0, config=ForestConfig(visits=99.0, block=16)))
    want = _brute(vectors)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for _, i in got[q]] == [i for _, i in want[q]]
        assert np.allclose([s for s, _ in got[q]], [s for s, _ in want[q]], atol=1e-12)


def test_few_candidates_and_empty_tables(table):
    got = _got(nearest(table([(0, [1.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0])]), F.col("vec_id") % 100 == 0))
    assert [i for _, i in got[0]] == [1]
    assert nearest(table([(0, [0.0, 0.0, 0.0])]), F.lit(True)).count() == 0
    assert nearest(table([(0, [1.0])]).limit(0), F.lit(True)).count() == 0


def test_recall_on_the_given_vectors(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = _got(nearest(vectors, F.col("vec_id") % 100 == 0))
    rows = [(r.vec_id, np.array(r.embedding, dtype=float)) for r in vectors.collect()]
    hits = 0
    for q, near in got.items():
        x = dict(rows)[q]
        best = sorted((float(np.sqrt(((v - x) ** 2).sum())), i) for i, v in rows if i != q)[:10]
        hits += len({i for _, i in best} & {i for _, i in near})
    assert hits >= 0.9 * 10 * len(got)


def test_equal_vectors_make_one_leaf():
    tree = fit_tree(np.ones((500, 4)), ForestConfig(), 1)
    assert tree.leaves == 1
