import random
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from helpers import COLUMNS, documents, words

from leakwatch.llm import text_tries
from leakwatch.llm.text_tries import RadixTrie, audit, failure_masks


def mask_of(text, has_smaller):
    w = words(text)
    a = [len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text), any(c in "#$%&*|" for c in text), has_smaller]
    return sum(x << k for k, x in enumerate(a))


def masks(rows):
    """rows: (id, text, part)."""
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    return [(i, p or "", mask_of(t or "", i is not None and i > least[t or ""])) for i, t, p in rows]


def expected(rows, labels):
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    found = defaultdict(list)
    for i, part, m in masks(rows):
        found[part].append((m, i is not None and i in good, i is not None and i in toxic))
    out = []
    for part, docs in found.items():
        shapley = Counter()
        steps = []
        for order in permutations("ABCDE"):
            before = 0
            for k, f in enumerate(order):
                own = 1 << "ABCDE".index(f)
                removed = [d for d in docs if d[0] & own and not d[0] & before]
                redundant = sum(bool(d[0] & own and d[0] & before) for d in docs)
                before_after = sum(not d[0] & (before | own) for d in docs)
                shapley[f] += len(removed)
                steps.append(("".join(order), k + 1, f, before_after, len(removed), redundant, sum(d[0] == own for d in docs), sum(d[1] for d in removed), sum(d[2] for d in removed)))
                before |= own
        out += [(part, o, k, *rest, shapley[f]) for o, k, f, *rest in steps]
    return sorted(out)


def awkward(seed, n=120):
    r = random.Random(seed)
    start = "shared license line " * r.choice([1, 30])
    base = [start + " ".join(r.choice(["Ab", "c", "D#", "eé", "f"]) * r.randrange(1, 4) for _ in range(r.randrange(150))) for _ in range(n // 3)]
    base += ["", None, "a", "ab", "abcd", "abcde", "x" * 40_000, " \n", "\x00\x00\x00\x00\x00"]
    rows = [(r.choice([None, *range(60)]) if r.random() < 0.2 else k * 3, r.choice(base), r.choice(["en", "de", None, ""])) for k in range(n)]
    return rows + [(k, "hot copy of one text " * 4, "en") for k in range(1000, 1060)] + rows[:7]


@pytest.mark.parametrize("seed,group_bytes", [(1, 1 << 22), (2, 200), (3, 0)])
def test_masks_equal_brute_force(spark, monkeypatch, seed, group_bytes):
    monkeypatch.setattr(text_tries, "SALTS", 3)
    rows = awkward(seed)
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, lang string, n int, route string").repartition(5)
    got = Counter()
    for r in failure_masks(docs, group_bytes=group_bytes).collect():
        got[r.id, r.part, r.mask] += r.n
    assert got == Counter(masks(rows))


def test_more_heavy_prefixes_than_allowed(spark, monkeypatch):
    monkeypatch.setattr(text_tries, "MAX_HEAVY", 2)
    rows = awkward(4)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sum(r.n for r in failure_masks(docs, group_bytes=10).collect() if r.mask & 16) == sum(m >= 16 for _, _, m in masks(rows))


def test_audit_equals_brute_force(spark):
    docs, rows = documents(spark, n=90)
    labels = [(r[0], k % 2, k % 3 % 2) for k, r in enumerate(rows[::2])] + [(None, 1, 1), (rows[0][0], 1, None), (-5, 1, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = audit(docs, table)
    columns = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert got.columns == columns
    assert sorted(map(tuple, got.collect())) == expected([r[:3] for r in rows], labels)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], COLUMNS)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit(docs, labels).count() == 0


def test_trie_terminals_hold_the_smallest_id():
    r = random.Random(7)
    for _ in range(100):
        trie, least = RadixTrie(), {}
        for k in range(50):
            text = "".join(r.choice("ab") for _ in range(r.randrange(9))).encode()
            key = r.randrange(100)
            trie.insert(text, key, (k,))
            least[text] = min(key, least.get(text, key))
        assert {t: i for t, i, _ in trie.walk()} == least
        assert sum(len(rows) for _, _, rows in trie.walk()) == 50
