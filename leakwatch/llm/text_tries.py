"""Filter interaction audit, with exact duplicates found by radix tries.

Which filter removes a document depends on the order of the filters. Every
document gets a mask of the filters that it fails; the masks are counted per
part, and each order is played on the counts, so its cost does not grow with
the table.

Four filters look at one text. The fifth one, a copy of the text of a smaller
id, is found by compressed tries. Texts are dealt by ranges of their
prefixes, and the prefixes adapt to the texts: bytes are summed over prefixes
of 4, 8, 16, ... bytes, and a text goes by its shortest prefix that holds
less than ``GROUP_BYTES``; texts that share a passage at their start go by a
longer one. All texts of a prefix meet in one task, which inserts them whole
into a radix trie: an edge holds as many bytes as no other text parts, and a
terminal holds the smallest id. A walk over the trie then flags the rows of
each terminal that have a larger id.

Copies are reduced before they travel: of equal texts in one batch of a task
only those with the smallest id enter a trie, the others are duplicates
already. A text all of whose prefixes are heavy (many copies of it) first
goes to one of ``SALTS`` tries, and only the smallest id of each goes on to
the last one, so a text that a third of all rows share ends in a task with at
most ``SALTS`` rows.

Defined results: a null text is empty; words are those of the whole text;
rows that share an id and a text are judged alike (a row is no copy of a row
with the same id); a null id is no copy and has none; a null part is the
empty string; an id is labelled if any of its label rows says so; an empty
table gives an empty result; other columns, whatever their names, are not
read. Very long texts are inserted whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leakwatch.llm.cells import give_back
from leakwatch.llm.tables import arrow_batches, written
from leakwatch.llm.textcodes import chunks

FILTERS = "ABCDE"
MIN_WORDS = 100
MIN_DISTINCT_PERCENT = 80
MAX_UPPER_PERCENT = 10
SYMBOLS = b"#$%&*|"
DUPLICATE = 1 << FILTERS.index("E")
#: A prefix with more bytes of text than this is made longer.
GROUP_BYTES = 4 << 20
#: Prefixes that are too heavy go to every task: at most so many, of 8 bytes each.
MAX_HEAVY = 2_000_000
SHORTEST = 4
SALTS = 1024
_UPPER = bytes(range(65, 91))
_CONTINUED = bytes(range(0x80, 0xC0))
_ROWS = "id long, part string, mask int, n long, route binary, text binary"
_ROWS_ARROW = pa.schema([("id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("n", pa.int64()), ("route", pa.binary()), ("text", pa.binary())])


def text_mask(text: bytes) -> int:
    """Bits of the filters that look at one text alone."""
    words = text.split()
    n = len(words)
    upper = len(text) - len(text.translate(None, _UPPER))
    points = len(text.translate(None, _CONTINUED))
    return (n < MIN_WORDS) | (100 * len(set(words)) < MIN_DISTINCT_PERCENT * n) << 1 | (100 * upper > MAX_UPPER_PERCENT * points) << 2 | (len(text.translate(None, SYMBOLS)) < len(text)) << 3


def prefix_codes():
    """Codes of the prefixes of 4, 8, 16, ... bytes that are shorter than the binary column ``text``."""
    levels = F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(F.octet_length("text"), F.lit(1)) / SHORTEST)).cast("int"))
    return F.when(levels > 0, F.transform(F.sequence(F.lit(0), levels - 1), lambda k: F.xxhash64(F.lit(0) + k, F.substring(F.col("text"), F.lit(1), F.call_function("shiftleft", F.lit(SHORTEST), k))))).otherwise(F.array().cast("array<long>"))


class RadixTrie:
    """Whole texts in edges, with the smallest id and all rows at their end.
    A node is [label, smallest id or None, rows, {first byte: node}]."""

    def __init__(self):
        self.root: list = [b"", None, [], {}]

    def insert(self, text: bytes, key: int, row: tuple = ()) -> None:
        node, at = self.root, 0
        while at < len(text):
            child = node[3].get(text[at])
            if child is None:
                node[3][text[at]] = child = [text[at:], None, [], {}]
            label = child[0]
            if text.startswith(label, at):
                node, at = child, at + len(label)
                continue
            same = common(label, text, at)
            node[3][text[at]] = node = [label[:same], None, [], {label[same]: child}]
            child[0] = label[same:]
            at += same
        node[1] = key if node[1] is None else min(node[1], key)
        node[2].append((key, *row))

    def walk(self) -> Iterator[tuple[bytes, int, list[tuple]]]:
        """(text, smallest id, rows) of every terminal."""
        stack = [(self.root, b"")]
        while stack:
            node, before = stack.pop()
            text = before + node[0]
            if node[1] is not None:
                yield text, node[1], node[2]
            stack += [(child, text) for child in node[3].values()]


def common(label: bytes, text: bytes, at: int) -> int:
    """Bytes that a label and a text from ``at`` share, by halving."""
    low, high = 0, min(len(label), len(text) - at)
    while low < high:
        half = (low + high + 1) // 2
        if text.startswith(label[:half], at):
            low = half
        else:
            high = half - 1
    return low


def _judged(batches: Iterator[pa.RecordBatch], heavy: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of ``_ROWS``: masks, and for texts that may be the first ones the text and its route (none: the whole text)."""
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for a, b in chunks(texts, 4 << 20):
            part = batch.slice(a, b - a)
            ids, parts = part.column("id").to_pylist(), part.column("part").to_pylist()
            least: dict[bytes, int] = {}
            for i, t in zip(ids, texts[a:b], strict=True):
                if i is not None:
                    least[t] = min(i, least.get(t, i))
            masks = {t: text_mask(t) for t in set(texts[a:b])}
            codes = part.column("codes")
            flat, bounds = codes.flatten().to_numpy(), np.concatenate([[0], np.cumsum(codes.value_lengths().to_numpy())])
            light = ~np.isin(flat, heavy)
            rows: dict[tuple, int] = {}
            place: dict[bytes, int] = {}
            for k, (i, t, name) in enumerate(zip(ids, texts[a:b], parts, strict=True)):
                first = i is not None and i == least[t]
                place[t] = k
                key = (i, name, masks[t] | (0 if first or i is None else DUPLICATE), t if first else None)
                rows[key] = rows.get(key, 0) + 1  # equal rows travel once
            out: list[list] = [[], [], [], [], [], []]
            for (i, name, mask, t), n in rows.items():
                route = None
                if t is not None:
                    own = light[bounds[place[t]] : bounds[place[t] + 1]]
                    route = t[: SHORTEST << int(own.argmax())] if own.any() else None
                for column, value in zip(out, (i, name, mask, n, route, t), strict=True):
                    column.append(value)
            yield pa.record_batch([pa.array(v, f.type) for v, f in zip(out, _ROWS_ARROW, strict=True)], schema=_ROWS_ARROW)
    give_back()


def _marked(batches: Iterator[pa.RecordBatch], last: bool) -> Iterator[pa.RecordBatch]:
    """Rows sorted by route, each route's texts through a trie of their own:
    duplicates are marked. Of rows that are not, the text stays unless this is
    the ``last`` trie, once for all rows of an id and part."""

    def flush() -> Iterator[pa.RecordBatch]:
        out: list[list] = [[], [], [], [], [], []]
        size = 0
        for text, least, rows in trie.walk():
            for i, part, mask, n in rows:
                first = i == least
                row = (i, part, mask if first else mask | DUPLICATE, n, None, text if first and not last else None)
                for column, value in zip(out, row, strict=True):
                    column.append(value)
                size += 1 if last else 1 + len(text)
                if size >= 1 << 20:
                    yield pa.record_batch([pa.array(v, f.type) for v, f in zip(out, _ROWS_ARROW, strict=True)], schema=_ROWS_ARROW)
                    out, size = [[], [], [], [], [], []], 0
        if out[0]:
            yield pa.record_batch([pa.array(v, f.type) for v, f in zip(out, _ROWS_ARROW, strict=True)], schema=_ROWS_ARROW)

    trie, now = RadixTrie(), None
    for batch in batches:
        for i, part, mask, n, route, text in zip(*(batch.column(c).to_pylist() for c in ("id", "part", "mask", "n", "route", "text")), strict=True):
            if route != now:
                yield from flush()
                trie, now = RadixTrie(), route
            trie.insert(text, i, (part, mask, n))
    yield from flush()
    del trie
    give_back()


def heavy_prefixes(texts: DataFrame, group_bytes: int = GROUP_BYTES) -> np.ndarray:
    """Codes of the prefixes with more than ``group_bytes`` bytes of text.
    Above ``MAX_HEAVY`` of them the bound is doubled until they are fewer: a
    task's groups are larger then, and none is lost."""
    weight = texts.select(F.explode(prefix_codes()).alias("code"), F.octet_length("text").cast("long").alias("n")).groupBy("code").agg(F.sum("n").alias("n"))
    weight = weight.where(F.col("n") > group_bytes).checkpoint()
    while weight.where(F.col("n") > group_bytes).count() > MAX_HEAVY:
        group_bytes *= 2
    return np.sort(weight.where(F.col("n") > group_bytes).select("code").toArrow().column(0).to_numpy())


def failure_masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(id, part, mask, n): how often which id of which part fails which filters (bits in the order of ``FILTERS``)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    heavy = spark.sparkContext.broadcast(heavy_prefixes(source, group_bytes))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _judged(batches, heavy.value)

    with arrow_batches(spark, rows=2048, size=4 << 20):
        rows = written(source.withColumn("codes", prefix_codes()).mapInArrow(judge, _ROWS), "judged", "zstd")
        n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        texts = rows.where("text is not null")
        hot = texts.where("route is null").withColumn("route", F.col("text")).withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
        hot = hot.repartition(n_parts, "route", "salt").sortWithinPartitions("route", "salt").drop("salt")
        hot = written(hot.mapInArrow(lambda b: _marked(b, last=False), _ROWS), "hot_texts", "zstd")
        left = texts.where("route is not null").union(hot.where("text is not null").withColumn("route", F.col("text")))
        dealt = left.repartitionByRange(n_parts, "route").sortWithinPartitions("route")
        marked = dealt.mapInArrow(lambda b: _marked(b, last=True), _ROWS).drop("route", "text").checkpoint()
    done = rows.where("text is null").union(hot.where("text is null"))
    return marked.union(done.select("id", "part", "mask", "n"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", group_bytes: int = GROUP_BYTES) -> DataFrame:
    """One row per part, order of the filters and step."""
    masks = failure_masks(docs, id_col, text_col, part_col, group_bytes)
    says = lambda c: F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(c)
    labels = labels.select(F.col(id_col).cast("long").alias("id"), "quality", "toxic").where("id is not null").groupBy("id").agg(says("quality"), says("toxic"))
    # A null id has no label: its rows stay out of the join, where they would be one key.
    unknown = masks.where("id is null").select("part", "mask", "n", F.lit(False).alias("quality"), F.lit(False).alias("toxic"))
    known = masks.where("id is not null").groupBy("id", "part", "mask").agg(F.sum("n").alias("n")).join(labels, "id", "left")
    false = lambda c: F.coalesce(c, F.lit(False)).alias(c)
    counts = known.select("part", "mask", "n", false("quality"), false("toxic")).union(unknown)
    counts = counts.groupBy("part", "mask", "quality", "toxic").agg(F.sum("n").alias("n")).checkpoint()

    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps = counts.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    bit = lambda k: F.call_function("shiftleft", F.lit(1), F.instr(F.lit(FILTERS), F.substring("filter_order", k, F.lit(1))) - 1)
    before = F.aggregate(F.filter(F.sequence(F.lit(1), F.lit(len(FILTERS))), lambda k: k < F.col("step")), F.lit(0), lambda acc, k: acc.bitwiseOR(bit(k)))
    steps = steps.withColumn("own", bit(F.col("step"))).withColumn("before", before)
    fails = F.col("mask").bitwiseAND(F.col("own")) > 0
    gone = F.col("mask").bitwiseAND(F.col("before")) > 0
    total = lambda on, name: F.sum(F.when(on, F.col("n")).otherwise(0)).alias(name)
    out = steps.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone, "kept"),
        total(fails & ~gone, "removed"),
        total(fails & gone, "redundant"),
        total(F.col("mask") == F.col("own"), "unique_fails"),
        total(fails & ~gone & F.col("quality"), "good_lost"),
        total(fails & ~gone & F.col("toxic"), "toxic_lost"),
    ).withColumn("own", F.substring("filter_order", F.col("step"), F.lit(1))).checkpoint()
    shapley = out.groupBy("part", "own").agg(F.sum("removed").alias("shapley"))
    return out.join(shapley, ["part", "own"]).select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
