"""Encoding to and decoding from the pieces of a public SentencePiece file.

Encoding works on distinct units. A text is cut between two characters only if
they stand side by side in no piece at all, so no piece is lost at a cut and
the best path of the text is that of its units: mostly a word with all spaces
before it, or a run of other characters. Units of up to ``MAX_UNIT`` characters:

1. every unit is exploded into its substrings of at most the longest piece,
   and these are joined with the piece table on the string;
2. the matches are the edges of the unit's lattice, grouped by unit (which
   needs no second shuffle: the units are already dealt by unit);
3. a higher-order ``aggregate`` folds the edges, end by end, into the best
   path: the smallest sum of costs, the longest piece on ties. A
   character without a piece is a costly edge and becomes its UTF-8 bytes.

The arrays of that fold grow with the square of a unit, so longer units pass
these steps without edges, and the same fold runs over them in one pass that
looks back by the longest piece.

The cost of a piece is log(``RANK_SHIFT`` - score). Files that hold merge ranks
as scores, not log probabilities, are meant to be applied merge by merge; the
best path under these costs gives the same pieces for 86 % of running units
(measured, see README), and always pieces that decode to the text.

Texts are put together from the unit table. The units that most tasks met are
broadcast (hashed, as packed arrays): at most ``max_broadcast`` units and
``IDS_PER_UNIT`` times as many ids. If there are more, each text asks once for
those of its units that are not among them; these are joined with the table on
the unit, and what is found is grouped by text and joined to the rows on a hash
of the text. So a row per unit is made for rare units only, and rows travel
once, as they are. The hash only leads to the row: units are compared whole.
A unit whose hash another unit shares is not broadcast, and one that the table
lacks (rows that are not the same when read again) is folded on the spot.

Defined results: a null text has null ids, an empty text none; a text that
holds the space mark itself keeps it (as bytes); decoding gives back every
text unchanged; rows that share an id are encoded one by one; an empty table
gives an empty result; columns named like the added ones are replaced.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leakwatch.llm import cells as C
from leakwatch.llm.tables import drop, written
from leakwatch.llm.textcodes import chunks

SPACE_MARK = "▁"
#: Never a character of a piece: stands for a space mark of the text itself.
NO_PIECE = "￿"
MAX_UNIT = 48
RANK_SHIFT = 500.0
#: Cost of a character without a piece: more than any path around it.
NO_PIECE_COST = 1000.0
MAX_BROADCAST = 2_500_000
CACHE_UNITS = 500_000
#: Bytes of new units that a task holds before it writes them.
CACHE_BYTES = 16_000_000
#: Rows of an Arrow batch, which is bounded by bytes as well.
BATCH_ROWS = 1024
IDS_PER_UNIT = 6
#: Texts that a task remembers, so as not to ask for the units of copies again.
CACHE_TEXTS = 200_000


class Cutter:
    """Cuts texts into units: where no piece has the two characters side by side."""

    def __init__(self, pieces: list[str]):
        pairs = {p[i : i + 2].replace(SPACE_MARK, " ") for p in pieces for i in range(len(p) - 1)}
        letters = sorted({c for p in pairs for c in p})
        number = {c: i for i, c in enumerate(letters, 1)}
        self.width = len(letters) + 1
        apart = np.ones((self.width, self.width), bool)
        for p in pairs:
            apart[number[p[0]], number[p[1]]] = False
        self.apart = apart.ravel()
        self.number = np.zeros(0x110000, np.int32 if self.width**2 < 1 << 31 else np.int64)  # 0: a character of no pair
        self.number[[ord(c) for c in letters]] = np.arange(1, self.width)

    def __call__(self, texts: list[str | None]) -> tuple[pa.Array, np.ndarray]:
        """The units of all texts one after the other, and the number of each text's."""
        ends = np.cumsum([0, *(len(t) + 1 if t else 0 for t in texts)])
        joined = "".join([" " + t for t in texts if t])
        at = self.number[np.frombuffer(joined.encode("utf-32-le"), "<u4")]
        cut = np.empty(len(at) + 1, bool)
        cut[1:-1] = self.apart[at[:-1] * self.width + at[1:]]
        cut[ends] = True
        cuts = np.flatnonzero(cut)
        size = np.diff(np.searchsorted(cuts, ends))
        raw = joined.encode()
        if len(raw) > len(at):
            begins = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
            cuts = np.append(begins, len(raw))[cuts]
        return pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(raw)), size


def load(path: str):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path)


def pieces_of(path: str) -> tuple[list[tuple[str, int, float]], int]:
    """(piece, id, cost) of the file, and the id of byte 0."""
    sp = load(path)
    rows, zero = [], None
    for i in range(sp.get_piece_size()):
        if sp.is_byte(i):
            zero = i if zero is None else zero
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            score = max(sp.get_score(i), -1e7)
            rows.append((sp.id_to_piece(i), i, float(np.log(RANK_SHIFT - score))))
    return rows, zero


def piece_table(spark: SparkSession, path: str) -> tuple[DataFrame, int, int]:
    """(piece, id, cost) of the file, its longest piece, and the id of byte 0."""
    rows, zero = pieces_of(path)
    table = spark.createDataFrame(rows, "piece string, id int, cost double")
    return table, max(len(r[0]) for r in rows), zero


def _best_ways(edges: Column, length: Column) -> Column:
    """For every place of a unit the best way there: (cost, start, token) of
    its last edge, the longest piece on ties. A token is a piece id, or minus
    the place of a character without one."""
    entry = lambda c, i, t: F.struct(c.alias("c"), i.alias("i"), t.alias("t"))
    by_end = F.transform(F.sequence(F.lit(1), length), lambda j: F.filter(edges, lambda e: e["j"] == j))
    start = F.array(entry(F.lit(0.0), F.lit(0), F.lit(0)))

    def step(best: Column, ending: Column) -> Column:
        ways = F.transform(ending, lambda e: entry(F.get(best, e["i"])["c"] + e["cost"], e["i"], e["t"]))
        return F.concat(best, F.array(F.array_min(ways)))

    return F.aggregate(by_end, start, step)


def _path(best: str, length: Column) -> Column:
    """Tokens of the best way to the end, from first to last."""
    begin = F.struct(length.cast("int").alias("at"), F.array().cast("array<int>").alias("path"))

    def hop(acc: Column, _: Column) -> Column:
        here = F.get(best, acc["at"])
        on = acc["at"] > 0
        return F.struct(
            F.when(on, here["i"]).otherwise(F.lit(0)).alias("at"),
            F.when(on, F.concat(F.array(here["t"]), acc["path"])).otherwise(acc["path"]).alias("path"),
        )

    return F.aggregate(F.sequence(F.lit(1), length), begin, hop, lambda acc: acc["path"])


def fold(unit: str, pieces: dict[str, tuple[int, float]], longest: int, zero: int) -> list[int]:
    """Ids of the best path of a unit of any length."""
    s = unit.replace(SPACE_MARK, NO_PIECE).replace(" ", SPACE_MARK)
    cost, start, token = array("d", [0.0]), array("q", [0]), array("i", [0])
    for j in range(1, len(s) + 1):
        best = (cost[j - 1] + NO_PIECE_COST, j - 1, -1) if s[j - 1] not in pieces else None
        for i in range(max(0, j - longest), j):
            here = pieces.get(s[i:j])
            if here is not None:
                way = (cost[i] + here[1], i, here[0])
                best = way if best is None or way < best else best
        cost.append(best[0])
        start.append(best[1])
        token.append(best[2])
    ids, j = [], len(s)
    while j:
        if token[j] >= 0:
            ids.append(token[j])
        else:
            ids.extend(zero + b for b in reversed(unit[j - 1].encode()))
        j = start[j]
    return ids[::-1]


def encode_units(units: DataFrame, path: str) -> DataFrame:
    """(unit, met, ids) of the distinct units of a table; met: rows that have the unit."""
    rows, zero = pieces_of(path)
    longest = max(len(r[0]) for r in rows)
    pieces = units.sparkSession.createDataFrame(rows, "piece string, id int, cost double")
    shared = units.sparkSession.sparkContext.broadcast({piece: (i, cost) for piece, i, cost in rows})

    @F.arrow_udf("array<int>")
    def folded(long: pa.Array) -> pa.Array:
        return pa.array([None if u is None else fold(u, shared.value, longest, zero) for u in long.to_pylist()], pa.list_(pa.int32()))

    # Long units stay among the others, without edges: the units are grouped once.
    distinct = units.na.drop().groupBy("unit").agg(F.max(F.length("unit")).alias("n"), F.count("*").alias("met"))
    short = F.col("n") <= MAX_UNIT
    u = F.col("unit")
    plain = F.when(F.contains(u, F.lit(SPACE_MARK)), F.replace(u, F.lit(SPACE_MARK), F.lit(NO_PIECE))).otherwise(u)
    marked = F.replace(plain, F.lit(" "), F.lit(SPACE_MARK))
    # Units are grouped by number first: the rows come in its order, which costs
    # the aggregate's sort nothing. The number serves within the stage only.
    df = distinct.select(F.monotonically_increasing_id().alias("u"), "unit", marked.alias("marked"), "n", "met")
    # One row per start with what follows, then one per length of that.
    rests = F.transform(F.sequence(F.lit(1), F.col("n")), lambda s: F.substr("marked", s, F.lit(longest)))
    df = df.select("u", "unit", "n", "met", F.posexplode_outer(F.when(short, rests)).alias("s", "rest"))
    df = df.select("u", "unit", "n", "met", "s", "rest", F.explode_outer(F.sequence(F.lit(1), F.length("rest"))).alias("k"))
    df = df.select("u", "unit", "n", "met", (F.col("s") + 1).alias("s"), "k", F.left("rest", "k").alias("piece"))
    df = df.join(F.broadcast(pieces), "piece", "left").where("id IS NOT NULL OR k = 1 OR k IS NULL")
    edge = F.struct(
        (F.col("s") + F.col("k") - 1).alias("j"),
        (F.col("s") - 1).alias("i"),
        F.coalesce("cost", F.lit(NO_PIECE_COST)).alias("cost"),
        F.coalesce("id", -F.col("s")).alias("t"),
    )
    df = df.groupBy("u", "unit", "n", "met").agg(F.collect_list(F.when(short, edge)).alias("edges"))
    as_bytes = lambda t: F.transform(
        F.sequence(F.lit(1), F.octet_length(F.substr("unit", -t, F.lit(1)))),
        lambda i: F.conv(F.substr(F.hex(F.encode(F.substr("unit", -t, F.lit(1)), "UTF-8")), 2 * i - 1, F.lit(2)), 16, 10).cast("int") + zero,
    )
    df = df.select("unit", "n", "met", F.when(short, _best_ways(F.col("edges"), F.col("n"))).alias("best"))
    df = df.select("unit", "n", "met", F.when(short, _path("best", F.col("n"))).alias("path"))
    ids = F.flatten(F.transform("path", lambda t: F.when(t >= 0, F.array(t)).otherwise(as_bytes(t))))
    ids = F.when(F.exists("path", lambda t: t < 0), ids).otherwise(F.col("path"))
    return df.select("unit", "met", F.coalesce(ids, folded(F.when(~short, F.col("unit")))).alias("ids"))


def _distinct(batches: Iterator[pa.RecordBatch], cut: Cutter) -> Iterator[pa.RecordBatch]:
    """Units that are new to the task; it forgets them when it holds too many."""
    seen, new = pa.array([], pa.string()), []

    def merged() -> pa.Array:
        return pc.unique(pa.concat_arrays([seen, *new])) if new else seen

    for batch in batches:
        texts = batch.column("text").to_pylist()
        for a, b in chunks(texts):
            units = pc.unique(cut(texts[a:b])[0])
            if units.nbytes > CACHE_BYTES:  # of one long text
                yield pa.record_batch([units], names=["unit"])
                continue
            new.append(units)
            if sum(map(len, new)) > len(seen) // 2 or sum(u.nbytes for u in new) > CACHE_BYTES:
                seen, new = merged(), []
                if len(seen) >= CACHE_UNITS or seen.nbytes >= CACHE_BYTES:
                    yield pa.record_batch([seen], names=["unit"])
                    seen = pa.array([], pa.string())
    seen, new = merged(), []
    if len(seen):
        yield pa.record_batch([seen], names=["unit"])
    del seen
    C.give_back()


def _places(units: pa.Array, code: np.ndarray) -> np.ndarray:
    """The place of each unit among the sorted codes, -1 if it is not there."""
    _, ends, raw = units.buffers()
    ends = np.frombuffer(ends, np.int32)[units.offset : units.offset + len(units) + 1].tolist() if len(units) else [0]
    raw = raw.to_pybytes() if raw else b""
    own = np.fromiter((xxhash.xxh64_intdigest(raw[a:b], 42) for a, b in pairwise(ends)), np.uint64, len(units)).view(np.int64)  # Spark's xxhash64
    if not len(code):
        return np.full(len(own), -1)
    order = np.argsort(own)  # a search in order stays in the caches
    place = np.empty(len(own), np.int64)
    place[order] = np.minimum(np.searchsorted(code, own[order]), len(code) - 1)
    return np.where(code[place] == own, place, -1)


def _wanted(batches: Iterator[pa.RecordBatch], cut: Cutter, code: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The units of each text that are not among the codes, with the text's key."""
    seen: set[int] = set()
    for batch in batches:
        if len(seen) > CACHE_TEXTS:
            seen.clear()
        fresh = [i for i, k in enumerate(batch.column("p_key").to_pylist()) if not (k in seen or seen.add(k))]
        batch = batch.take(pa.array(fresh, pa.int64()))
        keys, texts = batch.column("p_key").to_numpy(), batch.column("text").to_pylist()
        for a, b in chunks(texts):
            units, size = cut(texts[a:b])
            units = units.dictionary_encode()
            unit, n = units.indices.to_numpy(), len(units.dictionary)
            rare = np.flatnonzero((_places(units.dictionary, code) < 0)[unit])
            pair = np.unique(np.searchsorted(np.cumsum(size), rare, "right") * n + unit[rare])
            yield pa.record_batch([pa.array(keys[a:b][pair // max(n, 1)]), units.dictionary.take(pa.array(pair % max(n, 1)))], names=["p_key", "unit"])
    seen.clear()
    C.give_back()


def _look_up(
    texts: list[str | None], cut: Cutter, code: np.ndarray, first: np.ndarray, length: np.ndarray, pool: np.ndarray, own: tuple[pa.Array, pa.Array], pieces: Callable[[], tuple]
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, and the number of each text's. Each distinct unit is
    looked up once, first by its code and then among the texts' own units."""
    units, count = cut(texts)
    units = units.dictionary_encode()
    place = _places(units.dictionary, code)
    held, rare = np.flatnonzero(place >= 0), np.flatnonzero(place < 0)
    more = units.dictionary.take(pa.array(rare))
    found = own[1].take(pc.index_in(more, value_set=own[0]))
    if found.null_count:
        found = pa.array([fold(u, *pieces()) if x is None else x for u, x in zip(more.to_pylist(), found.to_pylist(), strict=True)], pa.list_(pa.int32()))
    # The ids of each distinct unit, then those of all units.
    size = np.empty(len(place), np.int64)
    size[held], size[rare] = length[place[held]], np.diff(found.offsets.to_numpy())
    ids = np.concatenate([pool[_spread(first[place[held]], size[held])], found.flatten().to_numpy()])
    begin = np.empty(len(place), np.int64)
    order = np.concatenate([held, rare])
    begin[order] = np.cumsum(size[order]) - size[order]
    unit = units.indices.to_numpy()
    ends = np.cumsum(np.concatenate([[0], size[unit]]))
    return ids[_spread(begin[unit], size[unit])], np.diff(ends[np.cumsum([0, *count])])


def _spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... of each range of so many places, one after the other."""
    ends = np.cumsum(np.concatenate([[0], size]))
    return np.repeat(begin - ends[:-1], size) + np.arange(ends[-1])


def _clashes(table: DataFrame) -> list[int]:
    """Codes that several units share: next to none of 64 bits."""
    return [r.code for r in table.groupBy("code").agg(F.count("*").alias("n")).where("n > 1").collect()]


def _packed(held: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The sorted codes, where the ids of each begin and how many, and the ids."""
    code, ids = held["code"].to_numpy(), pa.concat_arrays([c for c in held["ids"].chunks] or [pa.array([], pa.list_(pa.int32()))])
    order = np.argsort(code)
    least = lambda a: a.astype(np.min_scalar_type(a.max(initial=0)))
    bounds = ids.offsets.to_numpy()
    return code[order], bounds[:-1][order], least(np.diff(bounds)[order]), least(ids.values.to_numpy())


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids", max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """``docs`` with ``ids_col``, the piece ids of each whole text."""
    spark = docs.sparkSession
    C.whole_batches(spark, BATCH_ROWS)
    docs = docs.drop(*[c for c in docs.columns if c == ids_col])
    text = F.col(text_col).cast("string")
    rows, zero = pieces_of(path)
    longest = max(len(r[0]) for r in rows)
    cut = spark.sparkContext.broadcast(Cutter([r[0] for r in rows]))
    pieces = spark.sparkContext.broadcast({piece: (i, cost) for piece, i, cost in rows})
    met = docs.select(text.alias("text")).na.drop().mapInArrow(lambda batches: _distinct(batches, cut.value), "unit string")
    stored = written(encode_units(met, path), "units", "zstd", dictionary=False)
    table = stored.withColumn("code", F.xxhash64("unit"))
    # Units go to all tasks from those that most tasks met, as far as they fit.
    n = n_ids = 0
    kept, whole = F.lit(False), True
    for r in sorted(table.groupBy("met").agg(F.count("*").alias("n"), F.sum(F.size("ids")).alias("ids")).collect(), reverse=True):
        n, n_ids = n + r.n, n_ids + r.ids
        if n > max_broadcast or n_ids > IDS_PER_UNIT * max_broadcast:
            whole = False
            break
        kept = F.col("met") >= r.met
    if clashes := _clashes(table):
        kept, whole = kept & ~F.col("code").isin(clashes), False
    shared = spark.sparkContext.broadcast(_packed(table.where(kept).select("code", "ids").toArrow()))
    names = [text_col]
    if not whole:
        key = F.when(F.length(text) > 0, F.xxhash64(text)).otherwise(F.xxhash64(F.monotonically_increasing_id()))  # rows without units are spread
        asked = docs.select(F.xxhash64(text).alias("p_key"), text.alias("text")).where(F.length("text") > 0)
        found = asked.mapInArrow(lambda batches: _wanted(batches, cut.value, shared.value[0]), "p_key long, unit string").join(table.where(~kept).select("unit", "ids"), "unit")
        new = [f"p_{i}_" for i in range(3)]
        while {c.lower() for c in docs.columns} & set(new):
            new = [f"{c}_" for c in new]
        found = found.groupBy("p_key").agg(F.collect_list(F.struct("unit", "ids")).alias("own"))
        found = written(found.select(F.col("p_key").alias(new[0]), F.col("own.unit").alias(new[1]), F.col("own.ids").alias(new[2])), "units_of_texts", "zstd", dictionary=False)
        docs = docs.withColumn(new[0], key).join(found.hint("shuffle_hash"), new[0], "left").drop(new[0])
        names += new[1:]
    drop(stored)

    def ids_of_texts(texts: pa.Array, units: pa.Array, ids: pa.Array) -> pa.Array:
        raw = texts.to_pylist()
        known = lambda a, b: (units.slice(a, b - a).flatten(), ids.slice(a, b - a).flatten())
        parts = [_look_up(raw[a:b], cut.value, *shared.value, known(a, b), lambda: (pieces.value, longest, zero)) for a, b in chunks(raw)]
        ids, size = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.empty(0), np.empty(0, np.int64))
        bounds = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids.astype(np.int32)), mask=texts.is_null())

    @F.arrow_udf("array<int>")
    def ids_of(texts: pa.Array) -> pa.Array:
        none = pa.nulls(len(texts), pa.list_(pa.string())), pa.nulls(len(texts), pa.list_(pa.list_(pa.int32())))
        return ids_of_texts(texts, *none)

    @F.arrow_udf("array<int>")
    def ids_with_own(texts: pa.Array, units: pa.Array, ids: pa.Array) -> pa.Array:
        return ids_of_texts(texts, units, ids)

    # Otherwise Spark calls it anew inside every function of its ids, as decoding is.
    made = (ids_of if whole else ids_with_own).asNondeterministic()(text, *names[1:])
    return docs.withColumn(ids_col, made).drop(*names[1:])


def decode(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with ``text_col``, the text of the ids."""
    sp = load(path)
    size = sp.get_piece_size()
    shown = [
        bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) or sp.is_unknown(i) else sp.id_to_piece(i).replace(SPACE_MARK, " ").encode()
        for i in range(size)
    ]

    table = pa.array(shown, pa.binary())

    @F.arrow_udf("string")
    def text_of(ids: pa.Array) -> pa.Array:
        found = table.take(ids.flatten())
        count = np.diff(ids.offsets.to_numpy())
        count = np.where(ids.is_valid().to_numpy(zero_copy_only=False), count, 0)
        _, ends, raw = found.buffers()
        ends = np.frombuffer(ends, np.int32)[: len(found) + 1] if len(found) else np.zeros(1, np.int32)
        raw = np.frombuffer(raw, np.uint8)[: ends[-1]] if ends[-1] else np.empty(0, np.uint8)
        bounds = ends[np.concatenate([[0], np.cumsum(count)])]
        # The space that stands before every text goes again.
        lead = np.zeros(len(count), bool)
        some = np.flatnonzero(np.diff(bounds) > 0)
        lead[some] = raw[bounds[some]] == 0x20
        raw = np.delete(raw, bounds[:-1][lead])
        bounds = bounds - np.concatenate([[0], np.cumsum(lead)])
        text = pa.BinaryArray.from_buffers(pa.binary(), len(count), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(raw))])
        return pc.if_else(ids.is_valid(), text.cast(pa.string()), pa.scalar(None, pa.string()))

    return df.withColumn(text_col, text_of(F.col(ids_col)))
