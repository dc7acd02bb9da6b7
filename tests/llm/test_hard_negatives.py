"""Hard negatives against brute force, and the pruning against all products."""

import random

import numpy as np
import pytest

from daymill.llm import hard_negatives
from daymill.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    held = {}
    for i, vector, label in sorted((r for r in rows if None not in r), key=lambda r: r[0]):
        vector = np.array([np.nan if x is None else x for x in vector], np.float32).astype(np.float64)
        if len(vector) and np.isfinite(vector).all():
            held.setdefault(i, []).append(((label + 1) % 10 if i % 7 == 0 else label, tuple(np.floor(256 * vector).astype(int).tolist())))
    held = {i: min(v) for i, v in held.items()}
    out = []
    for a, (label, vector) in held.items():
        if a % 100:
            continue
        scored = sorted((-int(np.dot(vector, v)), i, own == label) for i, (own, v) in held.items() if i != a and len(v) == len(vector))
        for p, positive, _ in [s for s in scored if s[2]][:5]:
            fit = [(s, i) for s, i, same in scored if not same and 80 * -p <= 100 * -s <= 100 * -p][:5]
            out += [(a, positive, k + 1, i, -p, -s) for k, (s, i) in enumerate(fit)]
    return sorted(out)


def drawn(n, dim, seed, spread=1.0):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    return [
        (i, [draw.choice((0.5, 1, 3)) * (c + draw.gauss(0, spread)) for c in draw.choice(centres)], draw.randrange(4)) for i in range(n)
    ]


COPY = [0.5, -0.25, 1.0]
CASES = {
    "clusters": drawn(700, 6, 1, 0.3),
    "spread": drawn(500, 3, 2, 2.0),
    "copies": [(i, COPY if i % 3 else [float(i % 5), 1.0, -1.0], i % 2) for i in range(400)],
    "odd rows": drawn(250, 4, 3) + [
        (300, [0.0] * 4, 1), (400, [1.0, 2.0], 1), (401, [1.0, 1.0], 1), (402, [1.0, 1.0], 2), (500, None, 1), (600, [1.0, None, 1.0, 1.0], 1),
        (700, [float("nan")] * 4, 0), (800, [float("inf"), 0.0, 0.0, 0.0], 0), (900, [1.0] * 4, None), (1000, [], 0), (None, [1.0] * 4, 0),
        (100, [1.0] * 4, 3), (100, [1.0] * 4, 3),
    ],
    "negative scores": [(i * 100, [-1.0 if i % 2 else 1.0, 0.01 * i], 0) for i in range(12)] + [(i, [0.5, -0.01 * i], 1) for i in range(1, 40)],
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_rows(spark, tmp_path, monkeypatch, name):
    # Small buckets and rounds, so that the data has many.
    monkeypatch.setattr(hard_negatives, "BUCKET", 32)
    monkeypatch.setattr(hard_negatives, "FIRST_ROUND", 50)
    monkeypatch.setattr(hard_negatives, "SAMPLE", 4)
    spark.createDataFrame(CASES[name], SCHEMA).selectExpr("*", "1 as id", "'x' as bucket", "2 as low").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = sorted(tuple(r) for r in QUERIES["op12_hard_negatives"](spark, str(tmp_path)).collect())
    assert got == brute(CASES[name]) and got


def test_no_rows(spark):
    vectors = hard_negatives.Vectors(spark.createDataFrame([], SCHEMA))
    assert hard_negatives.mine(vectors, spark.range(3)).count() == 0


def test_candidates_hold_all_that_reach(spark):
    draw = np.random.default_rng(5)
    vectors = draw.integers(-300, 300, (500, 8))
    bucket = hard_negatives.Bucket(np.arange(500), np.zeros(500, int), vectors)
    fewer = 0
    for query in draw.integers(-300, 300, (50, 8)):
        products, length = vectors @ query, float(np.sqrt((query**2).sum()))
        assert (bucket.products(np.arange(500), query, length) == products).all()
        for least in np.quantile(products, [0.3, 0.9, 0.99, 1.0]):
            rows = bucket.candidates(query, length, least)
            assert set(np.flatnonzero(products >= least)) <= set(rows)
            fewer += len(rows) < 500
    assert fewer > 50
    assert len(bucket.candidates(vectors[0], 1.0, 1e12)) == 0
