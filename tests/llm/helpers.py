"""Small tables with every awkward case, and brute-force twins."""

import random
import re

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, n_words string, shard int, id string"


def words(text):
    return WORD.findall(text or "")


def texts(seed=5, n=60):
    """Random texts with copies, near copies, shared passages, odd characters and very long ones."""
    rng = random.Random(seed)
    vocabulary = ["the", "of", "Zebra", "naïve", "ß", "x", "—", "wort", "über", "été", "data", "Data,", "row", "col umn", "😀"] + [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    out = []
    for _ in range(n):
        w = [rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 3, 4, 5, 12, 13, 14, 40, 150]))]
        if rng.random() < 0.3:
            at = rng.randrange(len(w) + 1)
            w[at:at] = passage[rng.randrange(10) :]
        out.append(rng.choice([" ", "\n", "\t ", "  "]).join(w))
    out += out[:6]
    near = [t.split(" ") for t in out if t.count(" ") > 100][:3]
    for w in near:
        for _ in range(3):
            v = list(w)
            v[rng.randrange(len(v))] = "changed"
            out.append(" ".join(v))
    out += [None, "", " \n\t ", "a", "a a a a a a a a a a a a a a a a a a a a a a a a a a", "y" * 5000, " ".join(rng.choice(vocabulary) for _ in range(30_000)), "\x00 nul \x1f", "<|endoftext|> ▁ Ünï"]
    return out


def documents(spark, seed=5, n=60):
    """Documents of ``texts`` with null and repeated ids, and columns whose
    names clash with those that operators add."""
    rng = random.Random(seed + 1)
    rows = []
    for i, t in enumerate(texts(seed, n)):
        lang = rng.choice(["en", "de", None, "fr"])
        rows.append((i * 20, t, lang, "src", len(t or ""), False, "clash", 7, "clash"))
    rows.append((None, "a null id with some words and words", "en", None, None, None, None, None, None))
    rows.append((40, rows[2][1], None, "again", None, None, None, None, None))  # a repeated id
    rows.append(rows[-3])
    rng.shuffle(rows)
    return spark.createDataFrame(rows, COLUMNS).repartition(3), rows


def components(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]


def rng(seed=3):
    return np.random.default_rng(seed)
