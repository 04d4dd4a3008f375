import numpy as np
import pyarrow as pa
from helpers import COLUMNS, documents
from pyspark.sql import functions as F

from leakwatch.llm import chat_perspectives, html_paths
from leakwatch.llm import sentencepiece_lattice as L
from leakwatch.llm.queries import tokenizer

TURNS = "conv_id long, turn long, role string, text string, seq string, k int"


def dialogues():
    rows = [(1, i, r, f"text {i}", "clash", 1) for i, r in enumerate(["system", "Ann", "Bob", "Ann", "Cy"])]
    rows += [(2, 0, None, "nobody", None, None), (2, 1, "Ann", None, None, None), (2, None, "Bob", "late", None, None), (2, 1, "Ann", None, None, None)]
    rows += [(3, 0, "system", "alone", None, None), (None, 0, "Ann", "<|im_end|>", None, None), (4, 0, "", "empty name", None, None)]
    return rows


def rendered(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or ""))
        for who in {r[2] for r in turns} - {None, "system"}:
            text, masks = "", []
            for r in turns:
                role = "assistant" if r[2] == who else "system" if r[2] == "system" else "user"
                text += f"<|im_start|>{role}" + (f" name={r[2]}" if role == "user" and r[2] is not None else "") + "\n"
                begin = len(text)
                text += (r[3] or "").replace("<|", "< |") + "<|im_end|>\n"
                if role == "assistant":
                    masks.append((begin, len(text)))
            out[conv, who] = (text, masks)
    return out


def check_dialogues(spark, rows):
    got = chat_perspectives.rotate(spark.createDataFrame(rows, TURNS)).collect()
    views = {}
    for r in sorted(got, key=lambda r: r.seq):
        views.setdefault((r.conv_id, r.perspective), []).append(r)
    result = {}
    for key, segments in views.items():
        text = "".join(s.content for s in segments)
        assert [s.seq for s in segments] == list(range(len(segments)))
        assert all(text[s.start : s.stop] == s.content for s in segments)
        result[key] = (text, [(s.mask_start, s.mask_stop) for s in segments if s.mask_start is not None])
    assert result == rendered(rows)


def test_dialogues_equal_brute_force(spark):
    check_dialogues(spark, dialogues())


def test_hot_conversation_is_split(spark, monkeypatch):
    monkeypatch.setattr(chat_perspectives, "HOT_TURNS", 20)
    monkeypatch.setattr(chat_perspectives, "ROWS_PER_RANGE", 50)
    check_dialogues(spark, dialogues() + [(9, i, "ABC"[i % 3], "x" * (i % 7), None, None) for i in range(300)])


def test_dialogue_plan_is_native(spark):
    out = chat_perspectives.rotate(spark.createDataFrame(dialogues(), TURNS))
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert chat_perspectives.rotate(spark.createDataFrame([], TURNS)).collect() == []


def test_pieces_round_trip(spark):
    path = tokenizer("piece_bpe_32k.model")
    docs, rows = documents(spark)
    wide = L.decode(L.encode(docs, path), path).collect()
    joined = L.decode(L.encode(docs, path, max_broadcast=0), path).collect()
    assert len(wide) == len(rows)
    for r in wide:
        assert r.decoded == r.text and (r.ids is None) == (r.text is None) and (r.text != "" or r.ids == [])
    key = lambda r: (str(r.doc_id), str(r.text), str(r.source))
    assert [r.ids for r in sorted(wide, key=key)] == [r.ids for r in sorted(joined, key=key)]
    assert L.encode(spark.createDataFrame([], COLUMNS), path).collect() == []


def test_fold_equals_plain_viterbi(spark):
    path = tokenizer("piece_bpe_32k.model")
    table, longest, zero = L.piece_table(spark, path)
    pieces = {r.piece: (r.id, r.cost) for r in table.collect()}

    def viterbi(unit):
        s = ("▁" + unit[1:] if unit.startswith(" ") else unit).replace("￿", "")
        best = [(0.0, [])]
        for j in range(1, len(s) + 1):
            ways = []
            for i in range(max(0, j - longest), j):
                if s[i:j] in pieces:
                    ways.append((best[i][0] + pieces[s[i:j]][1], i, [*best[i][1], pieces[s[i:j]][0]]))
                elif j - i == 1:
                    ways.append((best[i][0] + L.NO_PIECE_COST, i, best[i][1] + [zero + b for b in unit[i:j].encode()]))
            best.append(min(ways, key=lambda w: (w[0], w[1]))[::2])
        return best[-1][1]

    cases = [" the", "the", " internationalisation", "\n", " ", " 中文字x", "éèê", " a\tb", "naïve,", " 𝒳𝒳", "x" * 47, " Don't"]
    got = {r.unit: r.ids for r in L.encode_units(spark.createDataFrame([(c,) for c in cases], "unit string"), path).collect()}
    assert got == {c: viterbi(c) for c in cases}


def test_agreement_with_the_library(spark):
    path = tokenizer("piece_bpe_32k.model")
    sp = L.load(path)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    got = L.encode(docs, path).collect()
    ours, theirs = sum(len(r.ids) for r in got), sum(len(sp.encode(r.text)) for r in got)
    assert 0.97 < ours / theirs < 1.03
    assert all(sp.decode(r.ids) == r.text for r in got[:50])


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style></head><body class="with-sidebar">
<header><h1>Site</h1><nav><a href="/">Home, sweet home. Yes.</a></nav></header>
<div class="cookie-notice"><p>We use cookies, and more. Accept, please.</p></div>
<div id="content"><h1>Head &lt;line&gt;</h1><p>First  paragraph,\n with <b>bold</b>, commas, and a stop.<br>Next line.<p>Second one, not closed, but long enough, too.
<ul><li>one<li>two</ul><blockquote>Quoted, by others.</blockquote><form><p>Sign up, now.</p></form>
<p>&Eacute;t&eacute;&nbsp;here, &#x41;. <script>if (a < b) { "</p>" }</script></p></div>
<aside><p>Aside, with commas, and stops.</p></aside>
<section id="comments"><h3>Comments</h3><div class="comment"><p>Great, really great. Thanks, all!</p></div></section>
<footer>Imprint, and so on.</footer></body></html>"""


def test_main_text_of_a_page():
    assert html_paths.main_text(PAGE) == "\n\n".join(
        ["Head <line>", "First paragraph, with bold, commas, and a stop. Next line.", "Second one, not closed, but long enough, too.", "one", "two", "Quoted, by others.", "Été here, A."]
    )


def test_broken_pages():
    for html, text in [(None, ""), ("", ""), ("no markup", "no markup"), ("<p>a<p>b < c", "a\n\nb < c"), ("<div", ""), ("<script>x", ""), ("<!-- x", ""), ("</p></div>z", "z"), ("<nav>only menu</nav>", ""), ('<p title="a>b">x</p>', "x"), ("<p 'open>y</p>", "y")]:
        assert html_paths.main_text(html) == text, html


def test_pages_of_the_table(spark):
    import re
    from html import unescape

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = html_paths.extract(pages).collect()
    assert len(got) == pages.count()
    for r in got:
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(unescape(re.sub("</?b>", "", b.replace("<br>", " "))).split()) for b in re.split("</?p>|</?h1>", article)]
        assert r.text == "\n\n".join(b for b in blocks if b)
    odd = spark.createDataFrame([(None, None, None, "clash"), (1, "u", "", "clash"), (1, "u", "", "clash")], "page_id long, url string, html string, text string")
    assert [r.text for r in html_paths.extract(odd).collect()] == ["", "", ""]


def test_long_page_with_many_open_quotes_is_read_in_time():
    assert html_paths.main_text("<p>" + "<a href='x>" * 2000 + "text") is not None
    assert np.isfinite(len(html_paths.main_text("<div>" * 3000 + "deep, text.")))


def test_names_of_what_is_around_the_article():
    story = "<h1>Head</h1><p>First, a long paragraph, with commas, and a stop.</p><p>Second one, long enough, too. And more, of it.</p>"
    want = "Head\n\nFirst, a long paragraph, with commas, and a stop.\n\nSecond one, long enough, too. And more, of it."
    side = '<div class="sidebar"><p>Other things, in short.</p></div>'
    talk = '<div id="comments"><p>Great, really great, thanks, all! More, of it, please, soon, and often.</p></div>'
    for begin, end in [
        ('<div class="content-sidebar-wrap">', "</div>"), ('<div id="page" class="has-sidebar">', "</div>"), ('<section class="post-with-comments">', "</section>"),
        ('<form action="x.aspx"><fieldset>', "</fieldset></form>"), ('<span class="widget">', "</span>"), ('<div class="share"><div class="related">', "</div></div>"),
    ]:
        for inner in (story, f"<article>{story}</article>"):
            assert html_paths.main_text(f"<body>{begin}{inner}{side}{talk}{end}</body>") == want, begin
    # Comments longer than the article are still left out, and so is a form beside it.
    for inner in (story, f"<article>{story}</article>"):
        assert html_paths.main_text(f"<body><div>{inner}</div>{talk.replace('</p>', '</p>' + '<p>Yes, indeed, so it is.</p>' * 9)}<form><p>Sign up, now.</p></form></body>") == want
    cards = '<div class="related">' + "<article><h2>Other</h2><p>One, more, story, elsewhere.</p></article>" * 9 + "</div>"
    assert html_paths.main_text(f"<body><article>{story}</article>{cards}</body>") == want


def test_nothing_of_the_main_text_lies_outside_the_nodes():
    long = [f"Paragraph {i}, of the story, with commas, and a stop. It goes on, and on, for a while, and then it ends." for i in range(14)]
    body = lambda part: "".join(f"<p>{t}</p>" for t in part)
    lead = "A lead, in short, of all that follows."
    beside = '<div class="links"><span>Home</span></div>'
    for around in ("{}", "<div>{}</div>", "<article>{}</article>"):
        page = f"<body>{beside}{around.format(f'<h1>Head</h1><p>{lead}</p><div class=body>{body(long)}</div>')}</body>"
        assert html_paths.main_text(page) == "\n\n".join(["Head", lead, *long]), around
    two = f"<body>{beside}<article><h1>One</h1>{body(long[:8])}<ul><li>item</ul></article>{beside}<article><h2>Two</h2>{body(long[8:])}</article></body>"
    assert html_paths.main_text(two) == "\n\n".join(["One", *long[:8], "item", "Two", *long[8:]])
    boxed = f"<body>{beside}<div class=top><h1>Head</h1></div><div class=by>By X</div><div class=body>{body(long)}</div></body>"
    assert html_paths.main_text(boxed) == "\n\n".join(["Head", "By X", *long])


def test_ids_are_the_best_path_of_the_whole_text(spark):
    path = tokenizer("piece_bpe_32k.model")
    rows, zero = L.pieces_of(path)
    pieces, longest = {p: (i, c) for p, i, c in rows}, max(len(p) for p, _, _ in rows)
    size = {i: len(p) for p, i, _ in rows}
    texts = [
        "    if x:\n\t        return a_b_{c}._d_->e", "=" * 300, "0123456789abcdef" * 40 + " z" + " " * 70, "中文字" * 60, "a" * 47 + "bcd" * 30, "▁▁ x  y ▁", "snake__case, and more.",
    ]
    whole = [L.fold(" " + t, pieces, longest, zero) for t in texts]
    for bound in (L.MAX_BROADCAST, 0):
        got = L.decode(L.encode(spark.createDataFrame(list(enumerate(texts)), "i int, text string"), path, max_broadcast=bound), path).collect()
        assert all(r.ids == whole[r.i] and r.decoded == r.text for r in got) and len(got) == len(texts)
    assert any(rows_of > 1 for rows_of in (size.get(i, 0) for i in whole[0])) and any(set(p) == {"▁"} and len(p) > 2 for p, i, _ in rows if i in whole[0] + whole[2])


def test_units_are_grouped_once_and_ids_made_once(spark):
    path = tokenizer("piece_bpe_32k.model")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    units = spark.createDataFrame([(" the",), (" the",), (None,), ("=" * 60,), ("\n",)], "unit string")
    df = L.encode_units(units, path)
    assert plan(df).count("Exchange hashpartitioning") == 1
    got = {r.unit: r.ids for r in df.collect()}
    rows, zero = L.pieces_of(path)
    pieces, longest = {p: (i, c) for p, i, c in rows}, max(len(p) for p, _, _ in rows)
    assert got == {u: L.fold(u, pieces, longest, zero) for u in (" the", "=" * 60, "\n")}
    docs = spark.createDataFrame([(1, "a b"), (2, None), (3, "")], "i int, text string")
    # Decoding takes the ids that encoding made, it does not make them again.
    assert "text_of(ids_of(" not in plan(L.decode(L.encode(docs, path), path).select("i", F.size("ids"), "decoded"))


def test_cuts_lie_where_no_piece_crosses(monkeypatch):
    cut = L.Cutter(["ab", "▁a", "bé", "𝒳b", "▁▁", "c"])
    pairs = {"ab", " a", "bé", "𝒳b", "  "}

    def plain(text):
        units = []
        for c in " " + text if text else "":
            if units and units[-1][-1] + c in pairs:
                units[-1] += c
            else:
                units.append(c)
        return units

    texts = [None, "", "ab", "  abé𝒳bc a", "b", None, "𝒳𝒳b", " ", "c\x00c", ""]
    for some in (texts, texts[:2], texts[:1], [], texts[2:3], texts[3:]):
        units, size = cut(some)
        assert units.to_pylist() == [u for t in some for u in plain(t)]
        assert size.tolist() == [len(plain(t)) for t in some]
    batches = [pa.record_batch([pa.array([t], pa.string())], names=["text"]) for t in texts * 3]
    want = {u for t in texts for u in plain(t)}
    # A task writes each new unit once, and forgets them when it holds too many.
    got = [u for b in L._distinct(iter(batches), cut) for u in b.column("unit").to_pylist()]
    assert sorted(got) == sorted(want)
    for name, bound in (("CACHE_UNITS", 2), ("CACHE_BYTES", 30), ("CACHE_BYTES", 0)):
        with monkeypatch.context() as m:
            m.setattr(L, name, bound)
            assert {u for b in L._distinct(iter(batches), cut) for u in b.column("unit").to_pylist()} == want
    assert list(L._distinct(iter([]), cut)) == []


def ids_by_fold(path, texts):
    rows, zero = L.pieces_of(path)
    pieces, longest = {p: (i, c) for p, i, c in rows}, max(len(p) for p, _, _ in rows)
    return {t: L.fold(" " + t, pieces, longest, zero) if t else [] for t in texts if t is not None} | {None: None}


def test_only_rare_units_are_joined(spark, monkeypatch):
    import glob
    import os
    from urllib.parse import urlparse

    path = tokenizer("piece_bpe_32k.model")
    texts = [" ".join(["the words that all of the texts have in common, over and over"] * 30 + [f"rare{chr(97 + i % 26)}{chr(97 + i // 26)}x"]) for i in range(200)]
    texts += [None, None, "", "", texts[0], texts[0], "=" * 60]
    want = ids_by_fold(path, texts)
    # A column that is named like one that the join adds stays.
    docs = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(texts)], "i int, text string, P_0_ string").repartition(5)
    at = urlparse(spark.sparkContext.getCheckpointDir()).path
    size = lambda: sum(os.path.getsize(f) for f in glob.glob(f"{at}/**", recursive=True) if os.path.isfile(f))
    text_bytes = sum(len(t) for t in texts if t)
    for bound in (0, 5, 20, L.MAX_BROADCAST):
        with monkeypatch.context() as m:
            asked = []
            m.setattr(L, "written", lambda df, name, *a, f=L.written, **b: asked.append((name, f(df, name, *a, **b))) or asked[-1][1])
            before = size()
            out = L.encode(docs, path, max_broadcast=bound)
            # No copy of the texts is kept.
            assert size() - before < text_bytes / 4
            got = out.collect()
        assert out.columns == ["i", "text", "P_0_", "ids"] and len(got) == len(texts)
        assert all(r.ids == want[r.text] and r.text == texts[r.i] and r.P_0_ == "kept" for r in got)
        assert [n for n, _ in asked] == (["units", "units_of_texts"] if bound < L.MAX_BROADCAST else ["units"])
        if bound == 20:  # the units in common are not among those joined
            own = asked[1][1].collect()
            assert 100 < len(own) < len(set(texts)) and all(len(r[1]) <= 2 for r in own)
    # Units whose codes are shared by others are compared as strings.
    some = [r.code for r in spark.createDataFrame([(" the",), (" words",), (" rareacx",)], "unit string").select(F.xxhash64("unit").alias("code")).collect()]
    monkeypatch.setattr(L, "_clashes", lambda table: some)
    assert all(r.ids == want[r.text] for r in L.encode(docs, path).collect())


def test_units_are_looked_up_by_code_and_then_by_name():
    path = tokenizer("piece_bpe_32k.model")
    rows, zero = L.pieces_of(path)
    pieces, longest = {p: (i, c) for p, i, c in rows}, max(len(p) for p, _, _ in rows)
    cut = L.Cutter([p for p, _, _ in rows])
    texts = ["the cat", None, "", "the naïve dog", "cat and dog and 中文"]
    want = ids_by_fold(path, texts)
    units = sorted({u for u in cut(texts)[0].to_pylist()})
    lists = pa.list_(pa.int32())
    folded = lambda some: pa.array([L.fold(u, pieces, longest, zero) for u in some], lists)
    for held in (units, units[::2], []):
        code = np.array([L.xxhash.xxh64_intdigest(u.encode(), 42) for u in held], np.uint64).view(np.int64)
        table = L._packed(pa.table({"code": pa.array(code, pa.int64()), "ids": folded(held)}))
        assert L._places(pa.array(held, pa.string()), table[0]).tolist() == np.argsort(np.argsort(code)).tolist()
        # The rest comes with the texts, twice over, or is folded.
        for own in (units + units, [u for u in units if u not in held][:2], []):
            ids, size = L._look_up(texts, cut, *table, (pa.array(own, pa.string()), folded(own)), lambda: (pieces, longest, zero))
            assert [x.tolist() for x in np.split(ids, np.cumsum(size)[:-1])] == [want[t] or [] for t in texts]
        keys = [5, 6, 7, 8, 9]
        batches = [pa.record_batch([pa.array(keys), pa.array([t or "" for t in texts])], names=["p_key", "text"])] * 2
        asked = [(r["p_key"], r["unit"]) for b in L._wanted(iter(batches), cut, table[0]) for r in b.to_pylist()]
        # Each text asks once for each unit that is not held.
        assert sorted(asked) == sorted((k, u) for k, t in zip(keys, texts, strict=True) for u in set(cut([t])[0].to_pylist()) - set(held))
