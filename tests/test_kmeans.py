import random

import numpy as np
import pytest

from obsgrid.operators.kmeans import kmeans_fit


def lloyd(x, k, rounds):
    """Plain Lloyd loop: first k rows as centres, lowest index on ties, empty keeps."""
    c = x[:k].copy()

    def label(c):
        d = ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
        return d.argmin(axis=1)

    lab = label(c)
    for _ in range(rounds):
        for i in range(k):
            if (lab == i).any():
                c[i] = x[lab == i].mean(axis=0)
        lab = label(c)
    return lab, c


def frame(spark, x):
    rows = [(float(i), 0.0, *map(float, r)) for i, r in enumerate(x)]
    feats = [f"f{j}" for j in range(x.shape[1])]
    schema = "longitude double, latitude double, " + ", ".join(f"{f} double" for f in feats)
    return spark.createDataFrame(rows, schema), feats


def test_lloyd_matches_numpy(spark):
    rnd = np.random.default_rng(5)
    x = np.vstack([rnd.normal(m, 1.0, size=(30, 4)) for m in (0, 6, 12)])
    rnd.shuffle(x)
    df, feats = frame(spark, x)
    labelled, centres = kmeans_fit(df, feats, k=3, rounds=10)
    lab, c = lloyd(x, 3, 10)
    got = [r.cluster for r in labelled.orderBy("longitude").collect()]
    assert got == list(lab)
    assert np.allclose(np.array(centres), c)


def test_k_larger_than_rows(spark):
    df, feats = frame(spark, np.zeros((2, 2)))
    with pytest.raises(ValueError):
        kmeans_fit(df, feats, k=3)


def test_empty_cluster_keeps_centre(spark):
    x = np.array([[0.0, 0.0], [0.0, 0.0], [10.0, 10.0], [10.0, 11.0]])
    df, feats = frame(spark, x)
    labelled, centres = kmeans_fit(df, feats, k=2, rounds=0)
    assert {r.cluster for r in labelled.collect()} == {0}  # ties go to the lowest index: cluster 1 is empty
    _, centres = kmeans_fit(df, feats, k=2, rounds=1)
    assert centres[0] == [5.0, 5.25]
    assert centres[1] == [0.0, 0.0]  # the empty cluster kept its centre


def test_assignment_cost_does_not_rise(spark):
    rnd = random.Random(2)
    x = np.array([[rnd.random() * 10, rnd.random() * 10] for _ in range(60)])
    df, feats = frame(spark, x)
    costs = []
    for rounds in range(0, 5):
        labelled, centres = kmeans_fit(df, feats, k=4, rounds=rounds)
        c = np.array(centres)
        lab = np.array([r.cluster for r in labelled.orderBy("longitude").collect()])
        costs.append(float(((x - c[lab]) ** 2).sum()))
    assert all(b <= a + 1e-9 for a, b in zip(costs, costs[1:]))


def test_seeded_random_init(spark):
    from obsgrid.operators.kmeans import initial_centres

    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(50, 3))
    df, feats = frame(spark, x)
    keys = ("longitude", "latitude")
    a = initial_centres(df, feats, keys, 4, init="random", seed=7)
    b = initial_centres(df, feats, keys, 4, init="random", seed=7)
    c = initial_centres(df, feats, keys, 4, init="random", seed=8)
    assert a == b and a != c
    rows = {tuple(r) for r in x.tolist()}
    assert len({tuple(v) for v in a}) == 4 and all(tuple(v) in rows for v in a)


def test_given_centres(spark):
    df = spark.createDataFrame([(0.0, 0.0, 1.0, 1.0), (1.0, 0.0, 9.0, 9.0), (2.0, 0.0, 1.2, 0.8)],
                               "longitude double, latitude double, a double, b double")
    lab, cen = kmeans_fit(df, ["a", "b"], k=2, rounds=2, centres=[[0.0, 0.0], [10.0, 10.0]])
    assert sorted((r.longitude, r.cluster) for r in lab.collect()) == [(0.0, 0), (1.0, 1), (2.0, 0)]
    assert cen == [[1.1, 0.9], [9.0, 9.0]]
    with pytest.raises(ValueError):
        kmeans_fit(df, ["a", "b"], k=2, rounds=1, centres=[[0.0], [1.0]])
