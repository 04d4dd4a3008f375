import random
import re
from collections import Counter, defaultdict

import pytest
from helpers import COLUMNS, documents

from leakwatch.llm import source_audit

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def expected(rows, min_docs, top):
    """rows: (text, lang, source)."""
    count, docs, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        t = terms(text)
        langs[lang or ""].add(source or "")
        count[lang or "", source or ""].update(t)
        docs[lang or ""].update(set(t))
    out = []
    for lang, sources in langs.items():
        kept = {t for t, n in docs[lang].items() if n >= min_docs}
        shares = lambda c: {t: 1 + 1000000000 * (c[t] + 5) // (sum(c[x] for x in kept) + 5 * len(kept)) for t in kept}
        whole = Counter()
        for s in sources:
            whole.update(count[lang, s])
        q, p = shares(whole), {s: shares(count[lang, s]) for s in sources}
        for s in sources:
            pair = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            term = [(t, p[s][t] - q[t]) for t in kept if count[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, items, most in (("pair", pair, None), ("term", term, top)):
                items = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(items)]
    return sorted(out)


def rows_of(seed, n=150):
    r = random.Random(seed)
    words = ["The", "the", "the,", "a-a", "a", "Élan", "élan", "über-x", "12", "--", "x1y", "中文", "zeta.", "zeta", "naïve(s)"] + [f"w{chr(97 + i)}" for i in range(26)]
    return [(" ".join(r.choice(words) for _ in range(r.randrange(40))), r.choice(["en", "en", "de", None, "xx"]), r.choice(["a", "b", "c", "d", None, "é"])) for _ in range(n)]


@pytest.mark.parametrize("seed,min_docs", [(1, 5), (2, 30), (3, 1000)])
def test_equals_brute_force(spark, monkeypatch, seed, min_docs):
    monkeypatch.setattr(source_audit, "TILE", 2)
    monkeypatch.setattr(source_audit, "TERMS_PER_SHARD", 7)
    monkeypatch.setattr(source_audit, "BATCH_BYTES", 600)
    rows = rows_of(seed)
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(3)
    got = source_audit.audit(docs, min_docs=min_docs, top=6)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == expected(rows, min_docs, 6)


def test_awkward_documents_without_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(source_audit, "MAX_BROADCAST", 0)
    monkeypatch.setattr(source_audit, "SLICE", 500)
    docs, rows = documents(spark, n=80)
    got = source_audit.audit(docs, min_docs=8, top=10)
    assert sorted(map(tuple, got.collect())) == expected([(r[1], r[2], r[3]) for r in rows], 8, 10)


def test_slices_end_at_white_space(monkeypatch):
    text = b"one two  three\nfourfivesix\tseven one " * 5
    whole = source_audit.Numbers().of(text).tolist()
    monkeypatch.setattr(source_audit, "SLICE", 7)
    numbers = source_audit.Numbers()
    assert numbers.of(text).tolist() == whole
    assert list(numbers) == [b"one", b"two", b"three", b"fourfivesix", b"seven"]


def test_large_counts_stay_exact(spark):
    n, total, v = 3_000_000_000_000_000, 9_000_000_000_000_001, 1_234_567
    got = spark.createDataFrame([(n, total, v)], "n long, t long, v long").select(source_audit.share(*(source_audit.F.col(c) for c in "ntv"))).first()[0]
    assert got == 1 + 1000000000 * (n + 5) // (total + 5 * v)


def test_empty_table(spark):
    assert source_audit.audit(spark.createDataFrame([], COLUMNS)).count() == 0
