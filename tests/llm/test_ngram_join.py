import numpy as np
import pyarrow as pa
import pytest
from helpers import COLUMNS, components, documents, rng, words

from leakwatch.llm import ngram_join
from leakwatch.llm.components import connected


def sets_of(rows, k=5):
    out = []
    for r in rows:
        w = words("".join(c.lower() if c.isascii() else c for c in r[1] or ""))
        out.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    return out


def expected(rows):
    sets = sets_of(rows)
    on = [i for i, r in enumerate(rows) if sets[i] and r[0] is not None]
    links = [(a, b) for a in on for b in on if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    root = components(len(rows), links)
    least = {}
    for i in on:
        least[root[i]] = min(least.get(root[i], rows[i][0]), rows[i][0])
    return sorted(((r[0], len(sets[i]), least[root[i]] if i in set(on) else r[0]) for i, r in enumerate(rows)), key=str)


@pytest.mark.parametrize("seed", [5, 6])
def test_equals_brute_force(spark, seed):
    docs, rows = documents(spark, seed)
    got = [tuple(r) for r in ngram_join.jaccard_components(docs).collect()]
    assert sorted(got, key=str) == expected(rows)


def chain(n):
    """Each text shares enough shingles with the next one, but not with those further on."""
    w = [f"w{i}" for i in range(60 + 7 * n)]
    return [(i, " ".join(w[7 * i : 7 * i + 60])) for i in range(n)]


def test_chains_and_tiles(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "TILE", 3)
    rows = [(i, t) for i, t in chain(25)] + [(100 + i, " ".join(f"v{j}" if j != 11 * i else "x" for j in range(300))) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in ngram_join.jaccard_components(docs).collect()]
    assert sorted(got, key=str) == expected(rows)


def test_tree_finds_every_pair_above_the_bound():
    r = rng()
    base = r.integers(0, 6, (12, ngram_join.GROUPS))
    points = np.concatenate([np.maximum(0, base[i % 12] + r.integers(-1, 2, ngram_join.GROUPS)) for i in range(200)]).reshape(200, -1)
    sizes = points.sum(1)
    need = ngram_join.needed(sizes[:, None], sizes[None], 75)
    bound = np.minimum(points[:, None], points[None]).sum(2)
    near = (100 * np.minimum(sizes[:, None], sizes[None]) >= 75 * np.maximum(sizes[:, None], sizes[None])) & (bound >= need)
    found = {(int(a), int(b)) for q, m in ngram_join.CountTree(points, sizes).search(points, sizes, 75, block=512) for a, b in zip(q, m, strict=True)}
    assert found == {(int(a), int(b)) for a, b in zip(*np.nonzero(near), strict=True)}


def kept_of(rows):
    """(id, text) of one row for each group of linked rows, and of every row that links with nothing."""
    sets = sets_of(rows)
    on = [i for i, r in enumerate(rows) if sets[i] and r[0] is not None]
    links = [(a, b) for a in on for b in on if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    root = components(len(rows), links)
    best = {}
    for i in on:
        mine = (rows[i][0], ngram_join.text_code(rows[i][1].encode()), rows[i][1])
        best[root[i]] = min(best.get(root[i], mine), mine)
    alone = [r[:2] for i, r in enumerate(rows) if not sets[i] or r[0] is None]
    return sorted([(i, t) for i, _, t in best.values()] + alone, key=str)


def test_kept_documents_are_the_first_of_their_group(spark):
    docs, rows = documents(spark)
    kept = ngram_join.keep_first(docs, ngram_join.jaccard_groups(docs))
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == kept_of(rows)


def test_rows_that_share_an_id_are_kept_one_by_one(spark):
    a, b = "one text of some words here and there", "another text that links with nothing at all"
    rows = [(1, a), (2, a), (2, b), (3, b + " "), (5, "x y z"), (5, "x y z"), (5, "x  y z"), (None, a), (None, a), (6, ""), (6, ""), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = ngram_join.keep_first(docs, ngram_join.jaccard_groups(docs)).collect()
    assert sorted(map(tuple, kept), key=str) == kept_of(rows)
    assert (2, b) in [tuple(r) for r in kept] and sum(r.doc_id == 5 for r in kept) == 1


@pytest.mark.parametrize("text", ["", "a", "naïve 😀" * 30, None])
def test_text_codes_are_sparks(spark, text):
    got = spark.createDataFrame([(text,)], "t string").selectExpr("xxhash64(t)").first()[0]
    assert got == ngram_join.text_code(None if text is None else text.encode())


def test_links_grow_with_the_members_not_with_their_pairs(spark):
    """Near copies: fewer links leave a task than members came."""
    r = rng()
    sent = {}
    for n in (40, 80, 160):
        base = [f"w{i}" for i in range(200)]
        rows = []
        for _ in range(n):
            at = int(r.integers(0, 190))
            rows.append(" ".join(base[:at] + [f"x{r.integers(10**9)}" for _ in range(7)] + base[at + 7 :]).encode())
        code, doc, size, _ = ngram_join.shingle_sets(rows, 5)
        parts = [code[doc == i] for i in range(n)]
        points = [np.bincount((c >> np.uint64(20)).astype(np.int64) % ngram_join.GROUPS, minlength=ngram_join.GROUPS).astype(np.uint32) for c in parts]
        batch = pa.record_batch({"node": np.arange(n), "n": size.astype(np.int64), "label": np.arange(n), "side": np.full(n, 2, np.int32),
                                 "points": pa.array([p.tobytes() for p in points], pa.binary()), "shared": pa.array([c.tobytes() for c in parts], pa.binary())})
        links = [(x, y) for out in ngram_join._tree_links([batch], 75) for x, y in zip(*(c.to_pylist() for c in out.columns), strict=True)]
        sets = [set(c.tolist()) for c in parts]
        every = [(i, j) for i in range(n) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
        assert components(n, links) == components(n, every)
        sent[n] = len(links)
    assert all(k < n for n, k in sent.items()) and sent[160] <= 5 * sent[40]


def test_empty_tables(spark):
    assert ngram_join.jaccard_components(spark.createDataFrame([], COLUMNS)).collect() == []
    assert connected(spark.createDataFrame([], "a long, b long")).collect() == []


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 60)] + [(7, 7), (None, 3), (5, 4), (4, 5)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {1000 + i: 1000 for i in range(1, 60)}
