import hashlib
import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from creditframe.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int, p string, a string"


def brute(rows, k, rounds, dim):
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v, *_ in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return {}
    key = lambda r: (r[0] is None, r[0] is not None and hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1])
    centres = np.array([v for _, v in sorted(kept, key=key)[:k]], np.int64)
    x = np.array([v for _, v in kept], np.int64)

    def near():
        d = ((x[:, None, :] - centres[None, :, :]) ** 2).sum(2)
        return d.argmin(1), d.min(1)

    for _ in range(rounds):
        a, _ = near()
        for c in range(len(centres)):
            if (a == c).any():
                centres[c] = np.floor_divide(x[a == c].sum(0), (a == c).sum())
    a, d = near()
    out = {}
    for (i, _), c, dist in zip(kept, a, d):
        out.setdefault(i, []).append((int(c), int(dist), int(d[a == c].sum()), int(d.sum()),
                                      hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest()))
    return {i: sorted(v) for i, v in out.items()}


def run(spark, rows, k, rounds, dim):
    assigned, centres = centroids.cluster(spark.createDataFrame(rows, SCHEMA), k=k, rounds=rounds, dim=dim)
    found = centroids.with_inertia(assigned, centres).collect()
    out = {}
    for r in found:
        out.setdefault(r.vec_id, []).append((r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256))
    return {i: sorted(v) for i, v in out.items()}


def test_edge_cases(spark):
    rows = [
        (1, [0.1, 0.2, 0.3], 0, "x", "y"),
        (2, [0.1, 0.2, 0.3], 0, "x", "y"),  # equal vectors: ties
        (3, [-0.5, 0.9, -0.01], 1, None, None),
        (3, [-0.5, 0.9, -0.01], 1, None, None),  # repeated row
        (None, [0.7, -0.7, 0.0], 1, None, None),  # no id
        (4, [0.1, None, 0.3], 1, None, None),  # null component: left out
        (5, [0.1, float("nan"), 0.3], 1, None, None),  # not finite: left out
        (6, [0.1, float("inf"), 0.3], 1, None, None),
        (7, [0.1, 0.3], 1, None, None),  # other length: left out
        (8, None, 1, None, None),
        (9, [1.0, 1.0, 1.0], 1, None, None),
    ]
    got = run(spark, rows, 3, 2, 3)
    assert got == brute(rows, 3, 2, 3)
    assert set(got) == {1, 2, 3, None, 9}


def test_fewer_vectors_than_centroids_and_empty(spark):
    rows = [(1, [0.5, 0.5], 0, None, None), (2, [0.25, -0.5], 0, None, None)]
    assert run(spark, rows, 40, 5, 2) == brute(rows, 40, 5, 2)
    assert run(spark, [], 40, 5, 2) == {}


@given(st.lists(st.lists(st.sampled_from([-0.5, -0.25, 0.0, 0.01, 0.25, 0.5, 0.75]), min_size=4, max_size=4), min_size=1, max_size=80),
       st.integers(1, 9))
@settings(max_examples=25, deadline=None)
def test_equal_to_brute_force(spark, vectors, k):
    rows = [(i, v, 0, None, None) for i, v in enumerate(vectors)]
    assert run(spark, rows, k, 5, 4) == brute(rows, k, 5, 4)


def test_assignment_step_equals_full_scan():
    rng = np.random.default_rng(7)
    for _ in range(100):
        n, d, k = rng.integers(1, 200), rng.integers(1, 5), rng.integers(1, 15)
        x = rng.integers(-3, 4, (n, d)).astype(np.int64)
        centres = x[rng.choice(n, min(k, n), replace=False)].copy()
        a, b, u, l, shifts = [np.zeros(n, np.int64)] * 2 + [np.zeros(n)] * 2 + [None]
        for _ in range(5):
            a, b, u, l, dist = centroids.assign(x, centres, shifts, a, b, u, l)
            full = ((x[:, None, :] - centres[None, :, :]) ** 2).sum(2)
            assert (a == full.argmin(1)).all() and (dist == full.min(1)).all()
            moved = centres.copy()
            for c in range(len(centres)):
                if (a == c).any():
                    moved[c] = np.floor_divide(x[a == c].sum(0), (a == c).sum())
            shifts, centres = np.sqrt(((moved - centres) ** 2).sum(1).astype(float)), moved
