"""Registered queries of the training-data operators, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leakwatch.llm import (
    chat_perspectives,
    embedding_dedup,
    html_paths,
    kneser_ney,
    language_mixture,
    ngram_join,
    packing,
    quality_rules,
    sentencepiece_lattice,
    source_audit,
    substring_dedup,
    text_tries,
    token_counts,
)
from leakwatch.llm.tables import remove, shared_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """Path of a public tokenizer file; it must be at the same place on every executor."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = substring_dedup.remove_repeated(docs, "doc_id", "text", window=13)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)
), first_doc AS (
  SELECT s, min(doc_id) AS first_id FROM win GROUP BY s
), gone AS (
  SELECT doc_id, list(DISTINCT p) AS ps FROM (
    SELECT win.doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN first_doc USING (s) WHERE win.doc_id > first_id
  ) GROUP BY doc_id
)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
  sha256(coalesce(array_to_string(list_filter(ws, lambda x, k: ps IS NULL OR NOT list_contains(ps, k)), ' '), '')) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id)
"""


def op2_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_perspectives.rotate(_table(spark, sf_dir, "conversations"))


OP2_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, role, text, replace(coalesce(text, ''), '<|', '< |') AS said FROM conversations
), p AS (
  SELECT DISTINCT conv_id, role AS perspective FROM conversations WHERE role IS NOT NULL AND role <> 'system'
), v AS (
  SELECT t.conv_id, perspective, turn, t.role AS speaker, text, said,
    CASE WHEN t.role = perspective THEN 'assistant' WHEN t.role = 'system' THEN 'system' ELSE 'user' END AS role
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id
), h AS (
  SELECT *, CASE WHEN role = 'user' THEN replace(speaker, '<|', '< |') END AS name FROM v
), c AS (
  SELECT *, '<|im_start|>' || role || coalesce(' name=' || name, '') || chr(10) AS head FROM h
), s AS (
  SELECT *, head || said || '<|im_end|>' || chr(10) AS content FROM c
), r AS (
  SELECT *, sum(length(content)) OVER w AS stop, row_number() OVER w - 1 AS seq FROM s
  WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS LAST, speaker NULLS FIRST, text NULLS FIRST ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, perspective, seq::BIGINT AS seq, turn, role, name, content, (stop - length(content))::BIGINT AS start, stop::BIGINT AS stop,
  CASE WHEN role = 'assistant' THEN stop - length(content) + length(head) END::BIGINT AS mask_start,
  CASE WHEN role = 'assistant' THEN stop END::BIGINT AS mask_stop
FROM r
"""


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"), cos=0.93)


#: Cosines of float vectors near the threshold may differ in the last bit between engines; none of the given tables has such a pair.
OP3_SQL = """
WITH RECURSIVE e AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM e UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), c AS (
  SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
), n AS (
  SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM c LEFT JOIN n USING (vec_id)
"""


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = packing.pack(docs, tokenizer("word_bpe_49k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trusted text: all documents labelled as of good quality and not toxic;
    every fifth of them sets the thresholds, the model is learned from the rest."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    good = _table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0").select("doc_id")
    aside = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    # The labels grow with the documents: never broadcast them.
    model = kneser_ney.learn(docs.join(good.where(~aside).hint("merge"), "doc_id", "left_semi"), "text")
    scored = kneser_ney.score(docs, model, "text").drop("text").checkpoint()
    return kneser_ney.classify(scored, good.where(aside), "doc_id", "lang")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = quality_rules.judge(docs, "text", "lang")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_R = quality_rules.Rules()
OP6_SQL = rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, lang, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), c1 AS (SELECT *, regexp_replace(t, '\p{{Ll}}+', '', 'g') AS l1 FROM w
), c2 AS (SELECT *, regexp_replace(l1, '[\x20\x09-\x0D]+', '', 'g') AS l2 FROM c1
), c3 AS (SELECT *, regexp_replace(l2, '\p{{Lu}}+', '', 'g') AS l3 FROM c2
), c4 AS (SELECT *, regexp_replace(l3, '[.,;:!?]+', '', 'g') AS l4 FROM c3
), c5 AS (SELECT *, regexp_replace(l4, '\p{{Nd}}+', '', 'g') AS l5 FROM c4
), c6 AS (SELECT *, regexp_replace(l5, '[#*$%&|<>]+', '', 'g') AS l6 FROM c5
), b AS (
  SELECT *, [length(t) - length(l1), length(l1) - length(l2), length(l2) - length(l3), length(l3) - length(l4), length(l4) - length(l5),
             length(l5) - length(l6), length(l6)] AS bins FROM c6
), win AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)
), twice AS (
  SELECT doc_id, s FROM win GROUP BY ALL HAVING count(*) > 1
), rep AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM win JOIN twice USING (doc_id, s)) GROUP BY doc_id
), dup AS (
  SELECT doc_id, count(*) - count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM w)
  WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY doc_id
), refc AS (
  SELECT lang, k, sum(v) AS v FROM (SELECT lang, unnest(range(1, 8)) AS k, unnest(bins) AS v FROM b) GROUP BY ALL
), refs AS (
  SELECT lang, k, v / sum(v) OVER (PARTITION BY lang) AS q FROM refc
), n_lang AS (
  SELECT lang, sum(len(ws)) AS n FROM w GROUP BY lang
), common AS (
  SELECT lang, x, count(*) / any_value(n) AS q FROM (SELECT lang, u AS x FROM (SELECT lang, unnest(ws) AS u FROM w) WHERE length(u) <= {_R.common_len})
  JOIN n_lang USING (lang) GROUP BY lang, x HAVING count(*) >= {_R.common_share} * any_value(n)
), cd AS (
  SELECT doc_id, sqrt(greatest(0, sum(
    (CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2))) AS d
  FROM (SELECT doc_id, lang, k, v / length(t) AS p FROM (SELECT doc_id, lang, t, unnest(range(1, 8)) AS k, unnest(bins) AS v FROM b WHERE t <> ''))
  JOIN refs USING (lang, k) GROUP BY doc_id
), dc AS (
  SELECT doc_id, lang, x, count(*) AS c FROM (SELECT doc_id, lang, u AS x FROM (SELECT doc_id, lang, unnest(ws) AS u FROM w) WHERE length(u) <= {_R.common_len})
  GROUP BY ALL
), hist AS (
  SELECT doc_id, common.x, q, coalesce(c, 0) / len(ws) AS p FROM w JOIN common USING (lang) LEFT JOIN dc USING (doc_id, x) WHERE len(ws) > 0
), whole AS (
  SELECT doc_id, p, q FROM hist UNION ALL SELECT doc_id, greatest(0, 1 - sum(p)), greatest(0, 1 - sum(q)) FROM hist GROUP BY doc_id
), wd AS (
  SELECT doc_id, sqrt(greatest(0, sum(
    (CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2))) AS d
  FROM whole GROUP BY doc_id
), m AS (
  SELECT b.doc_id, len(ws)::BIGINT AS n_words, (length(t) - bins[2])::BIGINT AS word_chars, bins[6]::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words, length(t) AS n_chars, coalesce(cd.d, 0) AS char_d, coalesce(wd.d, 0) AS word_d
  FROM b LEFT JOIN rep USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN cd USING (doc_id) LEFT JOIN wd USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {_R.min_words_base} OR 100 * n_repeat_words > {_R.max_repeat_percent} * n_words AS base_failed,
  NOT (n_words < {_R.min_words_base} OR 100 * n_repeat_words > {_R.max_repeat_percent} * n_words
    OR (n_chars >= {_R.min_chars} AND char_d > {_R.max_char_distance} + {_R.char_slack} / sqrt(n_chars)) OR (n_words >= {_R.min_words} AND word_d > {_R.max_word_distance} + {_R.word_slack} / sqrt(n_words))) AS kept
FROM m
"""


def op7_html_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_paths.extract(_table(spark, sf_dir, "pages"), "html", "text")
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = language_mixture.learn(docs.where(~held_out), "text", "lang")
    out = language_mixture.predict(docs.select("doc_id", "text"), model, "text")
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    path = tokenizer("piece_bpe_32k.model")
    out = sentencepiece_lattice.decode(sentencepiece_lattice.encode(docs, path), path)
    return out.select(
        "doc_id",
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"),
        F.crc32(F.array_join("ids", " ").cast("binary")).alias("ids_crc32"),
        F.col("text").eqNullSafe(F.col("decoded")).alias("round_trip"),
    )


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.jaccard_components(docs, "doc_id", "text", k=5, percent=75)


OP10_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT a AS doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(b) AS component_id FROM reach LEFT JOIN n ON n.doc_id = a GROUP BY a
"""


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cache is new and empty, so every distinct text is encoded; it is removed after use."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    path = shared_path(spark, "token_counts")
    out = token_counts.count_tokens(docs, token_counts.DigestCache(spark, path), tokenizer("byte_bpe_50k.json"))
    out = out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit")).checkpoint()
    remove(spark, path)
    return out


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(_table(spark, sf_dir, "documents").select("text", "lang", "source"), min_docs=30, top=50)


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(text, '') AS t, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents
), u AS (
  SELECT r, lang, source, unnest(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (
  SELECT lang, term, count(*)::HUGEINT AS n FROM u GROUP BY ALL HAVING count(DISTINCT r) >= 30
), v AS (
  SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang
), g AS (
  SELECT DISTINCT lang, source FROM d
), c AS (
  SELECT lang, source, term, count(*)::HUGEINT AS n FROM u JOIN kept USING (lang, term) GROUP BY ALL
), total AS (
  SELECT lang, source, coalesce(sum(c.n), 0)::HUGEINT AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL
), p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, 1 + (1000000000 * (coalesce(c.n, 0) + 5)) // (total.total + 5 * v.v) AS p,
    1 + (1000000000 * (kept.n + 5)) // (v.total + 5 * v.v) AS q
  FROM g JOIN total USING (lang, source) JOIN v USING (lang) JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
), pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL
), both_parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pair
  UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank FROM both_parts
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return text_tries.audit(docs, _table(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), least_id AS (
  SELECT t, min(doc_id) AS first_id FROM d GROUP BY t
), l AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
    (len(w) < 100)::INT + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT
    + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(doc_id > first_id, false)::INT AS mask
  FROM d JOIN least_id USING (t) LEFT JOIN l USING (doc_id)
), c AS (
  SELECT part, mask, good, toxic, count(*) AS n FROM m GROUP BY ALL
), f AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), bits AS (
  SELECT filter_order, step, (1 << (instr('ABCDE', substr(filter_order, step, 1)) - 1))::INT AS own,
    list_sum(list_transform(range(1, step), lambda k: (1 << (instr('ABCDE', substr(filter_order, k::INT, 1)) - 1))::INT))::INT AS earlier
  FROM (SELECT filter_order, unnest(range(1, 6))::INT AS step FROM o)
), b AS (
  SELECT filter_order, step, own, coalesce(earlier, 0) AS earlier FROM bits
), r AS (
  SELECT part, filter_order, step, own, sum(n) FILTER (mask & (own | earlier) = 0) AS kept,
    sum(n) FILTER (mask & own > 0 AND mask & earlier = 0) AS removed, sum(n) FILTER (mask & own > 0 AND mask & earlier > 0) AS redundant,
    sum(n) FILTER (mask = own) AS unique_fails, sum(n) FILTER (mask & own > 0 AND mask & earlier = 0 AND good = 1) AS good_lost,
    sum(n) FILTER (mask & own > 0 AND mask & earlier = 0 AND toxic = 1) AS toxic_lost
  FROM c, b GROUP BY ALL
)
SELECT part, filter_order, step::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
  coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost,
  coalesce(toxic_lost, 0)::BIGINT AS toxic_lost, coalesce(sum(removed) OVER (PARTITION BY part, own), 0)::BIGINT AS shapley
FROM r
"""

QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_chat_perspectives": op2_chat_perspectives,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_packing": op4_packing,
    "op5_kneser_ney": op5_kneser_ney,
    "op6_quality_rules": op6_quality_rules,
    "op7_html_paths": op7_html_paths,
    "op8_language_mixture": op8_language_mixture,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_ngram_join": op10_ngram_join,
    "op11_token_counts": op11_token_counts,
    "op12_source_audit": op12_source_audit,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE = {
    "op1_substring_dedup": OP1_SQL,
    "op2_chat_perspectives": OP2_SQL,
    "op3_embedding_dedup": OP3_SQL,
    "op6_quality_rules": OP6_SQL,
    "op10_ngram_join": OP10_SQL,
    "op12_source_audit": OP12_SQL,
    "op13_filter_audit": OP13_SQL,
}
