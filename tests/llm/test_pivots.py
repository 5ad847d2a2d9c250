"""Near-duplicate vectors: index and links against all pairs."""

import numpy as np
import pytest

from wirelens.llm import pivots
from wirelens.llm.pivots import Index


def at_cosine(r, x, c):
    x = x / np.linalg.norm(x)
    z = r.normal(size=x.shape)
    z -= (z @ x) * x
    return c * x + np.sqrt(1 - c * c) * z / np.linalg.norm(z)


def plain_links(ids, vectors, least=0.95):
    """n_links and component_id of every row, from all pairs."""
    n = len(ids)
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v) for v in vectors]
    link = np.zeros((n, n), bool)
    for dim in {len(v) for v, o in zip(vectors, ok, strict=True) if o}:
        at = [i for i in range(n) if ok[i] and len(vectors[i]) == dim]
        x = pivots.unit(np.array([vectors[i] for i in at]))
        link[np.ix_(at, at)] = x @ x.T >= least
    np.fill_diagonal(link, False)
    group, out = [-1] * n, []
    for i in range(n):
        if group[i] < 0:
            group[i], front = i, [i]
            while front:
                for j in np.flatnonzero(link[front.pop()]):
                    if group[j] < 0:
                        group[j] = i
                        front.append(j)
    for i in range(n):
        known = [ids[j] for j in range(n) if group[j] == group[i] and ids[j] is not None]
        out.append((ids[i], int(link[i].sum()), min(known, default=None) if ok[i] else ids[i]))
    return out


def frame(spark, ids, vectors):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], "x", 1) for i, v in zip(ids, vectors, strict=True)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, key string, label int").repartition(3)


def key(rows):
    return sorted(tuple(str(x) for x in r[:3]) for r in rows)


def test_links_equal_all_pairs(spark):
    """Near and exact copies, a hot group of either that takes several blocks, broken vectors, other lengths and ids that repeat."""
    r = np.random.default_rng(3)
    base, hot = r.normal(size=(150, 64)), r.normal(size=64)
    vectors = [*base, *(at_cosine(r, base[i], c) * r.uniform(0.1, 9) for i in range(60) for c in (0.9, 0.97, 0.99))]
    vectors += [hot] * 300 + [hot + 0.1 * r.normal(size=64) for _ in range(pivots.BLOCK + 200)]
    ids = list(range(len(vectors)))
    vectors += [None, [], [0.0] * 64, [float("nan")] * 64, [float("inf")] + [1.0] * 63, [None] * 64, [1.0] * 3, [2.0] * 3, [1.0] * 3, hot * 1e200, hot * 1e-200]
    ids += [None, 9001, 9002, 9003, 9004, 9004, 9005, 9006, 9005, 9007, None]
    got = pivots.link_vectors(frame(spark, ids, vectors)).collect()
    assert key(got) == key(plain_links(ids, vectors))
    assert all(x["kept"] == (x["vec_id"] == x["component_id"]) for x in got)


@pytest.mark.parametrize("cosine", [0.95, 0.96, 0.98])
def test_recall_of_the_index(cosine):
    """Pairs just above the threshold meet in a list, at every level of the index."""
    r = np.random.default_rng(5)
    x = pivots.unit(r.normal(size=(600, 64)))
    y = np.array([at_cosine(r, v, cosine) for v in x])
    for _, index in pivots.LEVELS:
        p = pivots.choose_pivots(pivots.unit(r.normal(size=(2 * index.pivots, 64))), 64, index.pivots)
        a, b = (pivots.nearest(v, p, index.near) for v in (x, y))
        met = [len(set(i) & set(j)) >= index.shared for i, j in zip(a.tolist(), b.tolist(), strict=True)]
        assert np.mean(met) >= 0.95


def test_a_pair_belongs_to_one_list():
    r = np.random.default_rng(7)
    index = Index(20, 6, 3)
    near = np.array([r.choice(20, 6, replace=False) for _ in range(40)], np.int32)
    import itertools

    seen = np.zeros((40, 40), int)
    for combo in itertools.combinations(range(20), 3):
        at = [k for k in range(40) if set(combo) <= set(near[k].tolist())]
        for part in (at, at[:10]):  # both ways of counting
            own = pivots.own_pairs(near[part], np.zeros(len(part)), combo[-1], index.shared, False) if part else np.zeros((0, 0), bool)
            if part is at:
                for i, j in zip(*np.nonzero(own), strict=True):
                    seen[at[i], at[j]] += 1
            else:
                assert (own == pivots.own_pairs(near[at], np.zeros(len(at)), combo[-1], index.shared, False)[: len(part), : len(part)]).all() if part else True
    for i, j in itertools.combinations(range(40), 2):
        assert seen[i, j] == (len(set(near[i].tolist()) & set(near[j].tolist())) >= 3)


def test_pivots_stand_apart_and_are_filled_up():
    r = np.random.default_rng(9)
    hot = r.normal(size=16)
    sample = pivots.unit(np.array([hot + 0.01 * r.normal(size=16) for _ in range(50)] + list(r.normal(size=(20, 16)))))
    p = pivots.choose_pivots(sample, 16, 40)
    assert p.shape == (40, 16) and np.allclose(np.linalg.norm(p, axis=1), 1, atol=1e-5)
    assert ((sample[:50] @ p.T) > 0.9).any(1).all() and ((p @ pivots.unit(hot[None])[0]) > 0.9).sum() == 1


def test_empty_and_unusable_tables(spark):
    none = frame(spark, [1], [[1.0]])
    assert pivots.link_vectors(none.where("false")).collect() == []
    got = pivots.link_vectors(frame(spark, [5, None, 4], [None, [0.0], [1.0, 2.0]])).collect()
    assert key(got) == [("4", "0", "4"), ("5", "0", "5"), ("None", "0", "None")] and all(r["kept"] for r in got)


def test_query_equals_all_pairs(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    assert key(pivots.op12_near_vectors(spark, sf).collect()) == key(plain_links([r["vec_id"] for r in rows], [r["embedding"] for r in rows]))
