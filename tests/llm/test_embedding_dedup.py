import inspect

import numpy as np
import pytest
from helpers import components, rng

from leakwatch.llm import embedding_dedup as E

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string, id int"


def table(spark, n=500, dim=20):
    r = rng()
    x = r.normal(size=(n, dim))
    for i in range(0, n, 3):
        x[i] = x[r.integers(n)] + r.normal(size=dim) * r.choice([0.05, 0.25, 0.3])
    x[10:60] = x[10]
    rows = [(i, [float(v) for v in x[i]], int(i % 3) if i >= 70 else 1, "clash", 1) for i in range(n)]
    bad = [None, [], [0.0] * dim, [None] + [1.0] * (dim - 1), [float("nan")] + [1.0] * (dim - 1), [float("inf")] + [1.0] * (dim - 1), [1.0, 2.0]]
    rows += [(1000 + i, v, 1, None, None) for i, v in enumerate(bad)]
    rows += [(1100, rows[10][1], None, None, None), (None, rows[10][1], 1, None, None), (1101, [2.0 * v for v in rows[10][1]], 1, None, None), (1102, [1.0, 2.0], 1, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4), rows


def expected(rows, cos=0.93):
    def sound(r):
        v = r[1]
        return r[0] is not None and r[2] is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    on = [i for i, r in enumerate(rows) if sound(r)]
    unit = {i: np.array(rows[i][1], np.float32).astype(float) for i in on}
    unit = {i: v / np.linalg.norm(v) for i, v in unit.items()}
    links = [(a, b) for a in on for b in on if a < b and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cos]
    root = components(len(rows), links)
    least = {}
    for i in on:
        least[root[i]] = min(least.get(root[i], rows[i][0]), rows[i][0])
    n = np.bincount([x for p in links for x in p], minlength=len(rows))
    out = [(r[0], int(n[i]), least[root[i]] if i in set(on) else r[0]) for i, r in enumerate(rows)]
    return sorted(((a, b, c, a is None or a == c) for a, b, c in out), key=str)


@pytest.mark.parametrize("tile", [E.TILE, 16])
def test_equals_brute_force(spark, tile, monkeypatch):
    monkeypatch.setattr(E, "TILE", tile)
    vectors, rows = table(spark)
    got = [tuple(r) for r in E.near_duplicates(vectors, deviations=None).collect()]
    assert sorted(got, key=str) == expected(rows)


def test_recall_of_the_default_probes(spark):
    vectors, rows = table(spark, 900, 64)
    got = E.near_duplicates(vectors).collect()
    want = {r[0]: r[1] for r in expected(rows)}
    found = sum(r.n_links for r in got)
    assert found >= 0.99 * sum(want.values()) and all(r.n_links <= want[r.vec_id] for r in got)


def test_lookup_distance_is_the_distance_to_the_coded_vector():
    r = rng()
    x = E.unit(list(r.normal(size=(300, 21))), 24)
    index = E.fit(list(r.normal(size=(200, 21))), 10_000, 0.9)
    home, code, error = E.encode(x, index)
    step = index.width // E.SUBSPACES
    coded = index.centroids[home] + np.concatenate([index.codewords[m][code[:, m]] for m in range(E.SUBSPACES)], 1)
    assert np.allclose(np.linalg.norm(x - coded, axis=1), error) and step == 3
    lst = int(home[0])
    of = home == lst
    assert np.allclose(E.lookup_distances(x[:5], lst, code[of], index), np.linalg.norm(x[:5, None] - coded[of][None], axis=2))


def test_empty_table(spark):
    assert E.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_vectors_longer_than_any_sampled_one(spark):
    vectors, rows = table(spark, 200)
    more = [(2000 + i, [1.0] * 40 + [float(i % 2)] * 20, 1, None, None) for i in range(4)]
    for sample_rows in (1, 30):
        got = E.near_duplicates(vectors.union(spark.createDataFrame(more, SCHEMA)), deviations=None, sample_rows=sample_rows).collect()
        assert sorted((tuple(r) for r in got), key=str) == expected(rows + more)


def test_skewed_vectors_miss_no_link():
    r = rng(1)
    spread = np.arange(1, 65) ** -1.5
    base = r.normal(size=(2250, 64)) * spread
    of = r.integers(len(base), size=750)
    x = E.unit(list(np.concatenate([base, base[of] + r.normal(size=(750, 64)) * spread * 0.3])), 64)
    a, b = of, np.arange(len(base), len(x))
    near = (x[a] * x[b]).sum(1) >= 0.93
    a, b = a[near], b[near]
    default = inspect.signature(E.near_duplicates).parameters["deviations"].default
    index = E.fit(list(x), len(x), 0.93, default)
    home = E._nearest(x, index.centroids)
    probed = set(zip(*(c.tolist() for c in E.probes(x, home, index)), strict=True))
    later, early = np.where(home[a] >= home[b], [a, b], [b, a])
    assert len(a) > 300 and all((int(i), int(home[j])) in probed for i, j in zip(later, early, strict=True))


def test_vectors_without_clusters_are_sent_a_few_times(spark, monkeypatch):
    x = rng().normal(size=(2000, 64))
    x[1000:1100] = x[:100] + rng().normal(size=(100, 64)) * 0.1
    rows = [(i, [float(v) for v in x[i]], i % 2, None, None) for i in range(len(x))]
    sent, deal = [], E.C.deal
    monkeypatch.setattr(E.C, "deal", lambda df, *args: sent.append(df.count()) or deal(df, *args))
    got = sorted((tuple(r) for r in E.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert got == expected(rows) and sent and max(sent) <= 3 * len(rows)


@pytest.mark.parametrize(("cos", "spread"), [(0.93, 0.0), (0.999999, 0.0), (0.93, 0.05), (0.3, 1.0)])
def test_tables_rule_no_link_out(cos, spread):
    r = rng()
    x = E.unit(list(np.repeat(r.normal(size=(40, 24)), 8, 0) + spread * r.normal(size=(320, 24))), 24)
    index = E.fit(list(x), 4000, cos)
    home, code, error = E.encode(x, index)
    ids = np.arange(len(x))
    entries = {"label": ids * 0, "size": ids * 0 + 24, "list": home, "id": ids, "weight": ids * 0 + 1, "error": error, "vector": x, "code": code}
    tile = E._tile([entries], index)
    links = [sorted((int(i), int(tile["id"][j]))) for a, b in E._linked(tile, entries, index, cos) for i, j in zip(a, b, strict=True)]
    want = np.argwhere(np.triu(x @ x.T >= cos, 1)).tolist()
    clear = lambda pairs: sorted(p for p in pairs if abs(x[p[0]] @ x[p[1]] - cos) > 1e-12)
    assert clear(links) == clear(want) and len(home) > len(set(home)) > 1
