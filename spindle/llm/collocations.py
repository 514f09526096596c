"""Phrase collocations by weighted acyclic automata.

A shard (a slice of the texts) sorts its n-grams and builds from them an
acyclic transducer that maps each n-gram to its count: nodes are registered
from the last word back, so equal continuations are one node, and counts are
pushed towards the root, so continuations that differ in their counts by a
constant are equal.  The n-grams of a shard are cut into ranges of their
prefix (in the order of a hash, so that ranges are even) and each range
travels as one transducer.  A range's transducers are united and their counts
summed.  For the scores, the parts of the candidates are run through the
transducer of the frequent phrases, range by range (a composition).

Words are counted first, then pairs of frequent words, then phrases all of
whose pairs are frequent: a phrase found 100 times has no rarer part.
Frequent words and pairs are handed on as bit sets of a fixed size
(``common.FILTER_BITS``), indexed by hash: a chance hit costs a row, never a result.

Scale: one pass over the texts for each of the three lengths; a repeated
phrase leaves a shard once, with its count, so a hot phrase or a group of
copies costs no more than any other; ranges are keyed by all words of the
shortest phrase counted, so a hot first word is split over them.  Part
lookups are salted by candidate.  The driver holds two bit sets of fixed
size.  Raise ``ranges`` (by default four for each shuffle partition) with the
data: a task holds one range at a time.

Edge cases: a null text is empty, a null lang is ``und``; pieces without a
word give nothing; repeated rows count each time; extra columns are ignored;
an empty table gives no rows.  Counts are exact below 10**15, words of a
language below 10**17.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spindle.llm.common import bit_set, cut, documents, in_set, slices, utf8
from spindle.llm.oracles import COLLOCATIONS
from spindle.llm.registry import query

MIN_COUNT = 100
TOP = 2000
MAX_WORDS = 5
#: Parts into which the lookups of one phrase are split.
SALTS = 8
SHARD_BYTES = 8 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_BREAK = np.zeros(256, bool)
_IS_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_IS_WORD = ~_IS_BREAK
_IS_WORD[[0x20, 0x09]] = False


# --- sorted rows of word numbers ----------------------------------------------

def sorted_groups(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The order of the rows by their columns, and where in it a new row
    begins.  Columns of small numbers share a key."""
    keys, width = [], 64
    for c in columns:
        need = max(int(c.max()).bit_length(), 1)
        if width + need > 63:
            keys.append(c.astype(np.int64))
            width = need
        else:
            keys[-1] = keys[-1] << need | c
            width += need
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[0] = True
    for k in keys:
        v = k[order]
        new[1:] |= v[1:] != v[:-1]
    return order, np.flatnonzero(new)


class CountTransducer:
    """Sequences of ``depth`` symbols to counts, over layers of arcs.

    ``words[i]`` is the symbol ``i + 1``; symbol 0 pads a sequence at its
    end.  Layer ``d`` has the arcs of states at depth ``d``, by state: where a
    state's arcs begin, their symbols, target states and gains.  A sequence's
    count is ``base`` and the gains on its path.
    """

    def __init__(self, words: pa.Array, base: int, layers: list[tuple]):
        self.words, self.base, self.layers = words, base, layers

    @classmethod
    def build(cls, words: pa.Array, paths: np.ndarray, counts: np.ndarray) -> CountTransducer:
        """From distinct rows in sorted order, registering nodes from the last
        symbol back."""
        n, depth = paths.shape
        first = [np.zeros(1, np.int64)]
        new = np.zeros(n, bool)
        new[0] = True
        for d in range(depth):
            new[1:] |= paths[1:, d] != paths[:-1, d]
            first.append(np.flatnonzero(new))
        target, total = np.zeros(n, np.int64), counts.astype(np.int64)
        layers = []
        for d in range(depth - 1, -1, -1):
            symbol = paths[first[d + 1], d]
            begin = np.searchsorted(first[d + 1], first[d])  # each node's first arc
            size = np.diff(np.append(begin, len(symbol)))
            low = np.minimum.reduceat(total, begin)
            gain = total - np.repeat(low, size)
            state, shown = cls._register(symbol, target, gain, begin, size)
            arcs = np.repeat(begin[shown] - np.append(0, np.cumsum(size[shown])[:-1]), size[shown]) + np.arange(size[shown].sum())
            layers.append((np.append(0, np.cumsum(size[shown])), symbol[arcs], target[arcs], gain[arcs]))
            target, total = state, low
        return cls(words, int(total[0]), layers[::-1])

    @staticmethod
    def _register(symbol, target, gain, begin, size) -> tuple[np.ndarray, np.ndarray]:
        """A state for each node, one for equal lists of arcs, and the node
        that each state shows."""
        state = np.empty(len(begin), np.int64)
        lone = np.flatnonzero(size == 1)  # its gain is 0
        at = begin[lone]
        _, shown, inverse = np.unique(symbol[at] * (int(target.max()) + 1) + target[at], return_index=True, return_inverse=True)
        state[lone] = inverse
        shown = list(lone[shown])
        known: dict[bytes, int] = {}
        arcs = np.stack([symbol, target, gain], axis=1)
        for node in np.flatnonzero(size > 1).tolist():
            key = arcs[begin[node]:begin[node] + size[node]].tobytes()
            found = known.setdefault(key, len(shown))
            if found == len(shown):
                shown.append(node)
            state[node] = found
        return state, np.array(shown, np.int64)

    def rows(self) -> tuple[np.ndarray, np.ndarray]:
        """All sequences, in order, and their counts."""
        state, counts = np.zeros(1, np.int64), np.full(1, self.base, np.int64)
        columns: list[np.ndarray] = []
        for begin, symbol, target, gain in self.layers:
            size = (begin[1:] - begin[:-1])[state]
            arc = np.repeat(begin[state] - np.append(0, np.cumsum(size)[:-1]), size) + np.arange(size.sum())
            columns = [np.repeat(c, size) for c in columns] + [symbol[arc]]
            counts = np.repeat(counts, size) + gain[arc]
            state = target[arc]
        return np.stack(columns, axis=1).astype(np.int64), counts

    def compose(self, words: pa.Array, paths: np.ndarray) -> np.ndarray:
        """Counts of the sequences ``paths`` over the symbols ``words``; -1
        for one that the transducer does not take."""
        here = pc.index_in(words, value_set=self.words).fill_null(-2).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        paths = np.append(0, here)[paths]
        state, counts = np.zeros(len(paths), np.int64), np.full(len(paths), self.base, np.int64)
        alive = np.ones(len(paths), bool)
        for d, (begin, symbol, target, gain) in enumerate(self.layers):
            wide = int(symbol.max()) + 2
            keys = np.repeat(np.arange(len(begin) - 1), np.diff(begin)) * wide + symbol
            alive &= (paths[:, d] >= 0) & (paths[:, d] < wide)
            want = np.where(alive, state * wide + paths[:, d], 0)
            at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            alive &= keys[at] == want
            counts, state = counts + gain[at], target[at]
        return np.where(alive, counts, -1)

    def to_bytes(self) -> bytes:
        small = lambda a: a.astype(np.min_scalar_type(int(a.max())))
        raw, off = utf8(self.words)
        body = (raw.tobytes(), small(np.diff(off)), self.base, [tuple(small(x) for x in (np.diff(layer[0]), *layer[1:])) for layer in self.layers])
        return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(body, protocol=5))

    @classmethod
    def from_bytes(cls, data: bytes) -> CountTransducer:
        raw, sizes, base, layers = pickle.loads(zstandard.ZstdDecompressor().decompress(data))
        off = np.append(0, np.cumsum(sizes, dtype=np.int64)).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(off), pa.py_buffer(raw)])
        wide = [tuple(x.astype(np.int64) for x in layer) for layer in layers]
        return cls(words, base, [(np.append(0, np.cumsum(layer[0])), *layer[1:]) for layer in wide])


def _fold(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Hash of a sequence from that of its beginning and its next word's."""
    h = (h ^ w) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ h >> np.uint64(32)


def _hashes(words: pa.Array) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words.to_pylist()), np.uint64, len(words))


# --- shards ----------------------------------------------------------------------

def tokenize(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words in order, each word's number (from 0) and text, and
    whether the next word follows it in the same piece."""
    raw, off = utf8(texts)
    word = _IS_WORD[raw]
    begin = word.copy()
    begin[1:] &= ~word[:-1]
    starts = off[:-1][off[:-1] < len(raw)]
    begin[starts] = word[starts]
    at = np.flatnonzero(begin)
    sizes = np.bincount(np.cumsum(begin, dtype=np.int32)[word] - 1, minlength=len(at)) if len(at) else np.zeros(0, np.int64)
    ends = np.append(0, np.cumsum(sizes)).astype(np.int32)
    data = _LOWER[raw[word]]
    coded = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(data)]).dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    text = np.searchsorted(off, at, "right") - 1
    breaks = np.cumsum(_IS_BREAK[raw], dtype=np.int32)[at] if len(at) else np.zeros(0, np.int32)
    joined = np.zeros(len(at), bool)
    joined[:-1] = (text[1:] == text[:-1]) & (breaks[1:] == breaks[:-1])
    return coded.dictionary.take(pa.array(order)), rank[coded.indices.to_numpy()] if len(at) else np.zeros(0, np.int64), text, joined


def shard_transducers(langs: pa.Array, texts: pa.Array, low: int, high: int, frequent: np.ndarray | None, ranges: int) -> Iterator[tuple[int, bytes]]:
    """(range, transducer) for the n-grams of ``low`` to ``high`` words: each
    place gives its longest, whose beginnings are the shorter ones.
    ``frequent``: bit set of the words (for pairs) or pairs (for longer)."""
    words, number, text, joined = tokenize(texts)
    if not len(number):
        return
    coded = langs.cast(pa.string()).fill_null("und").dictionary_encode()
    lang = coded.indices.to_numpy()[text].astype(np.int64)
    lang_hash = _hashes(coded.dictionary.cast(pa.binary()))[lang]
    word_hash = _hashes(words)[number]
    if low == 2:
        known = in_set(frequent, _fold(lang_hash, word_hash))
        joined[:-1] &= known[1:]
        joined &= known
    elif low > 2:
        joined[:-1] &= in_set(frequent, _fold(_fold(lang_hash[:-1], word_hash[:-1]), word_hash[1:]))
    size = np.ones(len(number), np.int64)
    going = np.ones(len(number), bool)
    for k in range(1, high):
        going[:len(number) - k + 1] &= joined[k - 1:]
        going[max(len(number) - k, 0):] = False
        size += going
    at = np.flatnonzero(size >= low)
    if not len(at):
        return
    prefix = lang_hash[at]
    for k in range(low):
        prefix = _fold(prefix, word_hash[at + k])
    part = ((prefix >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
    columns = [lang[at] + 1]
    for k in range(high):
        columns.append(np.where(size[at] > k, number[np.minimum(at + k, len(number) - 1)] + 1, 0))
    order, first = sorted_groups([part, *columns])
    counts = np.diff(np.append(first, len(order)))
    rows = np.stack([c[order[first]] for c in columns], axis=1)
    part = part[order[first]]
    cuts = np.flatnonzero(np.diff(part)) + 1
    lang_words = coded.dictionary.cast(pa.binary())
    for a, b in zip(np.append(0, cuts), np.append(cuts, len(part)), strict=True):
        names, codes = np.unique(rows[a:b, 0], return_inverse=True)
        used, inner = np.unique(rows[a:b, 1:], return_inverse=True)
        pad = int(used[0] == 0)
        own = pa.concat_arrays([lang_words.take(pa.array(names - 1)), words.take(pa.array(used[pad:] - 1))])
        inner = inner.reshape(b - a, high) + (0 if pad else 1)
        paths = np.column_stack([codes + 1, np.where(inner > 0, inner + len(names), 0)])
        yield int(part[a]), CountTransducer.build(own, paths, counts[a:b]).to_bytes()


def united(blobs: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words, distinct rows in order and summed counts of some transducers."""
    parts = [CountTransducer.from_bytes(b) for b in blobs]
    coded = pa.concat_arrays([p.words for p in parts]).dictionary_encode()
    codes, rows, counts, at = coded.indices.to_numpy().astype(np.int64) + 1, [], [], 0
    for p in parts:
        here = np.append(0, codes[at:at + len(p.words)])
        at += len(p.words)
        r, c = p.rows()
        rows.append(here[r])
        counts.append(c)
    rows, counts = np.concatenate(rows), np.concatenate(counts)
    order, first = sorted_groups(list(rows.T))
    return coded.dictionary, rows[order[first]], np.add.reduceat(counts[order], first)


_COUNTED = "lang string, phrase string, m int, a long, h long"


def _counted(blobs: list[bytes], low: int, high: int, min_count: int) -> pa.RecordBatch:
    words, rows, counts = united(blobs)
    out: list[tuple] = []
    hashes = None
    for m in range(low if low > 1 else 0, high + 1):
        held = np.flatnonzero(rows[:, m] > 0)
        if not len(held):
            break
        new = np.zeros(len(held), bool)
        new[0] = True
        for d in range(m + 1):
            new[1:] |= rows[held[1:], d] != rows[held[:-1], d]
        first = np.flatnonzero(new)
        total = np.add.reduceat(counts[held], first)
        often = np.flatnonzero(total >= (min_count if m else 1))
        texts = words.take(pa.array(rows[held[first[often]], :m + 1].ravel() - 1)).to_pylist()
        for k, a in enumerate(total[often].tolist()):
            lang, *phrase = texts[k * (m + 1):(k + 1) * (m + 1)]
            h = None
            if m == low:
                hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in (lang, *phrase)), np.uint64, m + 1)
                folded = hashes[:1]
                for w in hashes[1:]:
                    folded = _fold(folded, np.array([w], np.uint64))
                h = int(folded.astype(np.int64)[0])
            out.append((lang.decode(), b" ".join(phrase).decode() if m else None, m, a, h))
    columns = list(zip(*out, strict=True)) if out else [()] * 5
    kinds = (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["lang", "phrase", "m", "a", "h"])


def count_phrases(docs: DataFrame, low: int, high: int, frequent: np.ndarray | None, min_count: int = MIN_COUNT, ranges: int | None = None) -> DataFrame:
    """Phrases of ``low`` to ``high`` words with ``min_count`` or more: lang,
    phrase, m (words), a (count), h (hash of a phrase of ``low`` words).  From
    single words on, also a row for all words of a lang in a range (m 0)."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = ranges or 4 * parts
    shared = spark.sparkContext.broadcast(frequent)

    def emit(batches):
        for whole in batches:
            for part in slices(whole, "text", SHARD_BYTES):
                found = list(shard_transducers(part.column(0), part.column(1), low, high, shared.value, ranges))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in found], pa.int32()), pa.array([b for _, b in found], pa.binary())], names=["part", "blob"])

    def unite(batches):
        at, held = None, []
        for b in batches:
            for part, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if part != at and held:
                    yield _counted(held, low, high, min_count)
                    held = []
                at = part
                held.append(blob)
        if held:
            yield _counted(held, low, high, min_count)

    shards = docs.select(F.col("lang").cast("string").alias("lang"), "text").mapInArrow(emit, "part int, blob binary")
    return shards.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(unite, _COUNTED)


# --- part lookups ------------------------------------------------------------------

def _symbols(langs: pa.ChunkedArray, phrases: pa.ChunkedArray, depth: int) -> tuple[pa.Array, np.ndarray]:
    """Words and rows (lang, words, padding) of some phrases."""
    texts = pc.split_pattern(phrases.combine_chunks(), " ")
    langs = langs.combine_chunks()
    sizes = np.diff(texts.offsets.to_numpy())
    flat = pa.concat_arrays([langs, texts.flatten()]).cast(pa.binary()).dictionary_encode()
    codes = flat.indices.to_numpy().astype(np.int64) + 1
    rows = np.zeros((len(langs), depth + 1), np.int64)
    rows[:, 0] = codes[:len(langs)]
    inside = np.repeat(np.arange(len(langs)), sizes)
    place = np.arange(len(inside)) - np.repeat(np.append(0, np.cumsum(sizes)[:-1]), sizes)
    rows[inside, place + 1] = codes[len(langs):]
    return flat.dictionary, rows


def look_up(frequent: DataFrame, wanted: DataFrame, max_words: int, ranges: int) -> DataFrame:
    """``wanted`` (lang, part, phrase, a, k, side) with the count ``c`` of
    each part: both sides are cut into ranges, and the parts of a range go
    through the transducer of its frequent phrases."""
    place = lambda name: F.pmod(F.xxhash64("lang", name), F.lit(ranges)).cast("int")
    known = frequent.select(place("phrase").alias("_r"), F.explode(F.array(*[F.lit(s) for s in range(SALTS)])).alias("_s"), "lang", "phrase", "a")
    asked = wanted.select(place("part").alias("_r"), F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int").alias("_s"), *wanted.columns)

    def compose(left: pa.Table, right: pa.Table) -> pa.Table:
        kept = right.select(["lang", "part", "phrase", "a", "k", "side"])
        if not right.num_rows:
            return kept.append_column("c", pa.array([], pa.int64()))
        words, rows = _symbols(left["lang"], left["phrase"], max_words)
        order, _ = sorted_groups(list(rows.T))
        machine = CountTransducer.build(words, rows[order], left["a"].to_numpy()[order])
        counts = machine.compose(*_symbols(right["lang"], right["part"], max_words))
        if counts.min() < 0:
            raise ValueError("a part of a frequent phrase was not counted")
        return kept.append_column("c", pa.array(counts))

    schema = "lang string, part string, phrase string, a long, k int, side string, c long"
    return asked.groupBy("_r", "_s").cogroup(known.groupBy("_r", "_s")).applyInArrow(lambda r, l: compose(l, r), schema)  # noqa: E741


def score_phrases(frequent: DataFrame, totals: DataFrame, max_words: int = MAX_WORDS, ranges: int = 64) -> DataFrame:
    """Candidates that no longer one covers: lang, phrase, a, l, r, n, score
    of the lowest-scoring cut."""
    candidates = frequent.filter("m >= 2").withColumn("w", F.split("phrase", " "))
    cuts = candidates.select("lang", "phrase", "a", "w", "m", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"))
    wanted = cuts.select("lang", "phrase", "a", "k", F.explode(F.array(
        F.struct(F.lit("l").alias("side"), F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("part")),
        F.struct(F.lit("r").alias("side"), F.array_join(F.slice("w", F.col("k") + 1, F.col("m") - F.col("k")), " ").alias("part")))).alias("p"))
    wanted = wanted.select("lang", F.col("p.part").alias("part"), "phrase", "a", "k", F.col("p.side").alias("side"))
    found = cut(look_up(frequent, wanted, max_words, ranges), "parts")
    # a part one word shorter, as frequent as the whole, is covered by it
    last = F.size(F.split("phrase", " ")) - 1
    covered = found.filter((F.col("c") == F.col("a")) & (((F.col("side") == "l") & (F.col("k") == last)) | ((F.col("side") == "r") & (F.col("k") == 1))))
    covered = covered.select("lang", F.col("part").alias("phrase")).distinct()
    of = lambda side, k: F.max(F.when((F.col("side") == side) & (F.col("k") == k), F.col("c")))
    sides = found.groupBy("lang", "phrase", "a").agg(*[of(s, k).alias(f"{s}{k}") for k in range(1, max_words) for s in "lr"])
    score = "cast(1000 as decimal(4,0)) * cast(a as decimal(15,0)) * cast(n as decimal(17,0)) div (cast(l{k} as decimal(15,0)) * cast(r{k} as decimal(15,0)))"
    best = F.array_min(F.array(*[F.when(F.col(f"l{k}").isNotNull(), F.struct(
        F.expr(score.format(k=k)).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))) for k in range(1, max_words)]))
    scored = sides.join(totals, "lang").withColumn("best", best)
    return scored.join(covered, ["lang", "phrase"], "left_anti").select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")


def first_of_each(scored: DataFrame, top: int = TOP, salts: int = 64) -> DataFrame:
    """Each lang's first ``top`` by score, count and phrase, with their rank.
    Ranked in salted parts first: no task sorts a whole language."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    parts = scored.withColumn("_s", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    first = parts.withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_s").orderBy(*order))).filter(F.col("_r") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= top).drop("_s", "_r")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, max_words: int = MAX_WORDS, ranges: int | None = None) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best phrases
    of 2 to ``max_words`` (3 or more) words."""
    ranges = ranges or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = cut(count_phrases(docs, 1, 1, None, min_count, ranges), "words")
    pairs = cut(count_phrases(docs, 2, 2, bit_set(words.filter("m = 1")), min_count, ranges), "pairs")
    longer = cut(count_phrases(docs, 3, max_words, bit_set(pairs), min_count, ranges), "phrases")
    totals = words.filter("m = 0").groupBy("lang").agg(F.sum("a").alias("n"))
    frequent = words.filter("m = 1").unionByName(pairs).unionByName(longer)
    scored = score_phrases(frequent, totals, max_words, ranges)
    return first_of_each(scored, top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@query("op13_phrase_collocations", COLLOCATIONS)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of each language, over all documents."""
    return collocations(documents(spark, sf_dir))
