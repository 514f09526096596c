"""Exact repeats of long byte strings, by sharded suffix arrays.

A byte goes if it is in a ``width``-byte string that also starts earlier:
in a smaller doc_id, or earlier in the same text.

1. Every window of ``width`` bytes has an anchor: its least-hashed ``gram``
   bytes.  Equal windows have equal anchors, so windows can only be equal
   within one anchor.  Consecutive windows of equal anchors form a region, the
   bytes that they cover; text of a short period is one region, cut only
   every ``RUN`` windows.
2. A window also holds half of what surrounds its anchor, on the left or on
   the right.  Anchors with either half are counted; only regions with one
   that occurs twice go on.  The filter is a bit set of a fixed size, in which
   each key has three bits: at any size of the data it costs the same, and what
   it lets through by chance has no partner and falls out in step 4.
3. Equal regions: the first stays, all windows of the others are repeats.
   Groups are reduced by aggregates with partial sums, so thousands of
   copies of one region cost one row per task.
4. The bytes of the first regions are read from the texts only now, in a
   second scan that finds them by a bit set, too.  Different regions of an
   anchor are dealt to shards by the anchor (one with
   more than ``crowd`` regions to several, by the region).  A task drops
   regions that came by chance and are alone (``may_repeat``), fills
   lanes with whole shards, sorts their suffixes by induction (see
   induced_sort), and marks, in text order, which suffixes share
   ``width`` bytes with the one before them in suffix order (permuted common
   prefixes).  In each run of such suffixes all windows but the first go.
5. For crowded anchors the first windows of each shard are compared once
   more, by a 128-bit hash over all shards.
6. Spans are gathered by document and cut out.

Edge cases: null text is empty; texts shorter than ``width`` lose nothing.  A
null doc_id counts as the smallest id.  Of rows with one doc_id, the one in
which the string starts earlier keeps it; if it starts at the same place in
both, both keep it.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindle.llm import oracles
from spindle.llm.common import bit_set, cut, documents, in_set, slices, utf8
from spindle.llm.induced_sort import suffix_arrays
from spindle.llm.near_dup import BYTE_VALUE, PLACE_VALUE, _powers, mix
from spindle.llm.registry import query

WIDTH, GRAM = 100, 24
#: Windows of a region at most.
RUN = 1024
#: Bytes of an anchor's regions that are sorted in one shard at most, on average.
CROWD = 4096
#: Bytes of all lanes that are sorted in step, and of a lane.
BLOCK, LANE = 1 << 20, 4096
#: Bits of a filter (16 MB), and how many of them a key has: of the keys that
#: are not in it, it lets 1 in 100 through when it holds 10 million.
FILTER_BITS, PROBES = 1 << 27, 3
#: Bytes of text that are searched for anchors at once.
TEXT_STEP = 1 << 19

#: Regions in an Arrow batch.
STEP = 10_000

_LONG = T.LongType()


class Regions:
    """The regions of all texts in a row."""

    def __init__(self, texts: pa.Array, width: int = WIDTH, gram: int = GRAM):
        self.raw, self.off = utf8(texts)
        n, span = len(self.raw), width - gram + 1
        empty = np.zeros(0, np.int64)
        self.text = self.begin = self.count = self.places = empty
        self.anchor = self.content = empty
        if n < width:
            return
        power, inverse = _powers(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        self._sums, self._gram = (sums, inverse), gram
        np.cumsum(BYTE_VALUE[self.raw] * power[:n], out=sums[1:])
        grams = mix((sums[gram:] - sums[:-gram]) * inverse[:n - gram + 1])
        # least hash in the upper half, first place in the lower half
        least = (grams >> np.uint64(32) << np.uint64(32)) | np.arange(len(grams), dtype=np.uint64)
        reach = 1
        while 2 * reach <= span:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < span:
            rest = span - reach
            least = np.minimum(least[:len(least) - rest], least[rest:])
        place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        # windows that lie within one text
        lengths = np.diff(self.off)
        usable = np.maximum(lengths - width + 1, 0)
        owner = np.repeat(np.arange(len(lengths)), usable)
        if not len(owner):
            return
        first = np.cumsum(usable) - usable
        window = np.arange(len(owner)) - first[owner] + self.off[:-1][owner]
        at = place[window]
        other = owner[1:] != owner[:-1]
        # parts of one place, whose anchors with a half of their surroundings are the keys
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | other
        head = np.flatnonzero(new)
        last = window[np.append(head[1:], len(at)) - 1]
        side = (width - gram) // 2
        spot = at[head]
        left, right = window[head] <= spot - side, last >= spot + side - (width - gram)
        self._sides = spot, side, left, right
        part_of = np.cumsum(new) - 1
        # regions: parts of equal anchors, RUN windows at most
        anchor = grams[at]
        new[1:] = (anchor[1:] != anchor[:-1]) | other
        head = np.flatnonzero(new)
        size = np.diff(np.append(head, len(at)))
        if size.max() > RUN:
            pieces = -(-size // RUN)
            head = np.repeat(head, pieces) + RUN * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        self.count = np.diff(np.append(head, len(at)))
        self.text, begin = owner[head], window[head]
        self._parts = part_of[head], part_of[head + self.count - 1]
        self.places = self._parts[1] - self._parts[0] + 1
        self.begin = begin - self.off[:-1][self.text]
        end = begin + self.count + width - 1
        self.anchor = anchor[head].view(np.int64)
        self.content = mix((sums[end] - sums[begin]) * inverse[begin] + self.count.astype(np.uint64) * PLACE_VALUE[11]).view(np.int64)
        self._begin, self._end = begin, end

    @cached_property
    def keys(self) -> np.ndarray:
        """Hashes of the parts' anchors with what is left, and right, of them."""
        if not len(self.anchor):
            return self.anchor
        (spot, side, left, right), (sums, inverse), gram = self._sides, self._sums, self._gram
        hashed = lambda a, b: mix((sums[b] - sums[a]) * inverse[a])
        return np.concatenate((hashed(spot[left] - side, spot[left] + gram), hashed(spot[right], spot[right] + gram + side))).view(np.int64)

    def with_key_in(self, bits: np.ndarray) -> np.ndarray:
        """Which regions have a key that may be in the set."""
        _, _, left, right = self._sides
        found = in_set(bits, self.keys, PROBES)
        hit = np.zeros(len(left), np.int64)
        n = int(left.sum())
        hit[left] += found[:n]
        hit[right] += found[n:]
        total = np.append(0, np.cumsum(hit))
        return total[self._parts[1] + 1] > total[self._parts[0]]

    def bytes_of(self, which: np.ndarray) -> pa.Array:
        """The bytes of the regions ``which``."""
        begin, end = self._begin[which], self._end[which]
        size = end - begin
        off = np.concatenate(([0], np.cumsum(size)))
        data = self.raw[np.repeat(begin - off[:-1], size) + np.arange(off[-1])]
        return pa.Array.from_buffers(pa.binary(), len(which), [None, pa.py_buffer(off.astype(np.int32)), pa.py_buffer(data)])


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and what tells rows apart: id (never null) and row."""
    least = F.lit(-(1 << 63)).cast("long")
    return docs.select("doc_id", "text", F.coalesce(F.col("doc_id").cast("long"), least).alias("id"), F.xxhash64("doc_id", "text").alias("row"))


def _long(*names: str) -> list[T.StructField]:
    return [T.StructField(n, _LONG) for n in names]


def repeated_keys(docs: DataFrame, width: int, gram: int) -> DataFrame:
    """Keys (h) that occur twice."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", TEXT_STEP):
                yield pa.RecordBatch.from_arrays([pa.array(Regions(part.column("text"), width, gram).keys)], names=["h"])

    found = docs.select("text").mapInArrow(run, T.StructType(_long("h")))
    return found.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1").select("h")


#: ``places``: how often the anchor is in the region; in one with several, a window may occur again.
REGION = T.StructType(_long("anchor", "content", "id", "row", "begin", "windows", "places"))


def mark(content, row_id, begin):
    """Bits by which a region is told from its copies, alike in Spark and numpy."""
    if isinstance(content, np.ndarray):
        return content ^ row_id ^ (begin << 7)
    return F.col(content).bitwiseXOR(F.col(row_id)).bitwiseXOR(F.shiftleft(begin, 7))


def regions_where(docs: DataFrame, choose, width: int, gram: int, with_bytes: bool = False) -> DataFrame:
    """Regions of the texts that ``choose(regions, ids)`` is true for."""
    schema = T.StructType([*REGION.fields, *([T.StructField("bytes", T.BinaryType())] if with_bytes else [])])

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", TEXT_STEP):
                r = Regions(part.column("text"), width, gram)
                if not len(r.anchor):
                    continue
                doc, row = (part.column(part.schema.get_field_index(n)).to_numpy(zero_copy_only=False)[r.text] for n in ("id", "row"))
                which = np.flatnonzero(choose(r, doc))
                for k in range(0, len(which), STEP):
                    p = which[k:k + STEP]
                    cols = [c[p].astype(np.int64) for c in (r.anchor, r.content, doc, row, r.begin, r.count, r.places)]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, cols), *([r.bytes_of(p)] if with_bytes else [])], names=schema.fieldNames())

    return docs.select("text", "id", "row").mapInArrow(run, schema)


SPAN = T.StructType(_long("id", "row", "begin", "end"))
FOUND = T.StructType(_long("id", "row", "begin", "end", "hash1", "hash2"))


def _lanes(sizes: np.ndarray, target: int) -> list[list[int]]:
    """Groups in lanes of about one length, longest groups first."""
    lanes: list[list[int]] = []
    room = 0
    for g in np.argsort(-sizes, kind="stable").tolist():
        if not lanes or room < sizes[g]:
            lanes.append([])
            room = max(target, int(sizes[g]))
        lanes[-1].append(g)
        room -= int(sizes[g])
    return lanes


def sort_block(columns: dict[str, np.ndarray], blobs: list[bytes], shard: np.ndarray, crowded: np.ndarray, width: int, lane_size: int = LANE):
    """Repeats within the shards of a block: (id, row, begin) of windows that
    go, and (id, row, begin, hash1, hash2) of the first windows of
    crowded shards."""
    sizes = np.array([len(b) for b in blobs])
    group = np.unique(shard, return_inverse=True)[1]
    lanes = _lanes(np.bincount(group, sizes).astype(np.int64), lane_size)
    lane_of = np.zeros(int(group.max()) + 1, np.int64)
    for k, members in enumerate(lanes):
        lane_of[members] = k
    lane = lane_of[group]
    order = np.lexsort((np.arange(len(blobs)), lane))
    lane, sizes = lane[order], sizes[order]
    filled = np.bincount(lane, sizes, len(lanes)).astype(np.int64)
    start = np.cumsum(sizes) - sizes
    start -= (np.cumsum(filled) - filled)[lane]
    n = int(filled.max())
    text = np.zeros((n, len(lanes)), np.uint8)
    # which window of which region starts at each place of each lane
    region = np.full((n, len(lanes)), -1, np.int32)
    windows = columns["windows"][order]
    for k, r in enumerate(order.tolist()):
        a = int(start[k])
        text[a:a + sizes[k], lane[k]] = np.frombuffer(blobs[r], np.uint8)
        region[a:a + windows[k], lane[k]] = r
    real = np.arange(n)[:, None] < filled[None, :]
    text = np.where(real, text.astype(np.int32) + 1, np.int32(0))
    suffixes = suffix_arrays(text)

    # permuted common prefixes: equal if the hashes of width bytes are
    power = np.multiply.accumulate(np.full((n, 1), PLACE_VALUE[0]), 0)
    codes = []
    for salt in (np.uint64(1), np.uint64(1 << 40)):
        sums = np.zeros((n + width + 1, len(lanes)), np.uint64)
        np.cumsum(mix(text.astype(np.uint64) + salt) * power, 0, out=sums[1:n + 1])
        sums[n + 1:] = sums[n]
        inverse = np.multiply.accumulate(np.full((n, 1), np.uint64(pow(int(PLACE_VALUE[0]), -1, 1 << 64))), 0)
        codes.append((sums[width:width + n] - sums[:n]) * inverse)
    before = np.full((n, len(lanes)), -1, np.int64)
    np.put_along_axis(before, suffixes[1:], suffixes[:-1], 0)
    back = np.maximum(before, 0)
    common = before >= 0
    for code in codes:
        common &= np.take_along_axis(code, back, 0) == code
    new = ~np.take_along_axis(common, suffixes, 0)
    run = np.cumsum(new.T.ravel())
    place = suffixes.T.ravel()
    in_lane = np.repeat(np.arange(len(lanes)), n)
    which = region[place, in_lane]
    valid = which >= 0
    which, run, place, in_lane = which[valid], run[valid], place[valid], in_lane[valid]
    begins = np.zeros(len(blobs), np.int64)
    begins[order] = start
    at = columns["begin"][which] + place - begins[which]
    same = group[which]
    by = np.lexsort((at, columns["id"][which], same, run))
    which, run, at, same = which[by], run[by], at[by], same[by]
    place, in_lane = place[by], in_lane[by]
    first = np.ones(len(run), bool)
    first[1:] = (run[1:] != run[:-1]) | (same[1:] != same[:-1])
    # a window that starts at the same place of the same id as the first one stays too
    lead = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0)) if len(first) else first
    ids = columns["id"][which]
    stays = (ids == ids[lead]) & (at == at[lead])
    gone, open_ = ~stays, stays & crowded[which]
    pick = lambda m: (columns["id"][which[m]], columns["row"][which[m]], at[m])
    return pick(gone), (*pick(open_), *(mix(c[place[open_], in_lane[open_]]).view(np.int64) for c in codes))


def may_repeat(shard: np.ndarray, places: np.ndarray, crowded: np.ndarray) -> np.ndarray:
    """Regions that must be sorted.  One that is alone in its shard has nothing
    to repeat: it got there by chance, unless its anchor is in it again or others
    of the anchor are in other shards."""
    _, group, size = np.unique(shard, return_inverse=True, return_counts=True)
    return (size[group] > 1) | (places > 1) | crowded


def _runs(ids, rows, begins, width: int):
    """Windows as spans: consecutive starts of a text become one."""
    by = np.lexsort((begins, rows, ids))
    ids, rows, begins = ids[by], rows[by], begins[by]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (rows[1:] != rows[:-1]) | (begins[1:] > begins[:-1] + width)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(ids)) - 1 if len(ids) else head
    return ids[head], rows[head], begins[head], begins[tail] + width


def sort_shards(regions: DataFrame, width: int, block: int) -> DataFrame:
    """``regions`` with shard and crowded, in partitions sorted by shard, to
    spans that go and first windows of crowded shards (with hashes)."""
    def out(spans, hashes=None):
        k = len(spans[0])
        hashes = [pa.array(h, pa.int64()) for h in hashes] if hashes is not None else [pa.nulls(k, pa.int64())] * 2
        return pa.RecordBatch.from_arrays([*(pa.array(s, pa.int64()) for s in spans), *hashes], names=FOUND.fieldNames())

    def sort(parts):
        columns = {c: np.concatenate([p[c] for p in parts]) for c in ("id", "row", "begin", "windows", "shard", "crowded")}
        blobs = [b for p in parts for b in p["bytes"]]
        gone, first = sort_block(columns, blobs, columns["shard"], columns["crowded"], width)
        yield out(_runs(*gone, width))
        yield out((first[0], first[1], first[2], first[2] + width), first[3:])

    def solve(held, waiting):
        """Sort the shards that fit in a lane.  Lanes are padded to the
        longest, so longer shards wait for others of their length."""
        table = pa.Table.from_batches(held)
        table = table.filter(pa.array(may_repeat(*(table.column(c).to_numpy() for c in ("shard", "places", "crowded")))))
        columns = {c: table.column(c).to_numpy() for c in ("id", "row", "begin", "windows", "shard", "crowded")}
        blobs = table.column("bytes").to_pylist()
        sizes = np.array([len(b) for b in blobs])
        _, group = np.unique(columns["shard"], return_inverse=True)
        whole = np.bincount(group, sizes)[group]
        classes = np.maximum(np.ceil(np.log2(np.maximum(whole, 1) / LANE)), 0).astype(int)
        for c in np.unique(classes).tolist():
            at = np.flatnonzero(classes == c)
            part = {k: v[at] for k, v in columns.items()} | {"bytes": [blobs[i] for i in at.tolist()]}
            waiting.setdefault(c, []).append(part)
            if c == 0 or sum(len(b) for p in waiting[c] for b in p["bytes"]) >= block:
                yield from sort(waiting.pop(c))

    def run(batches):
        held, size, waiting = [], 0, {}
        for batch in batches:
            shard = batch.column(batch.schema.get_field_index("shard")).to_numpy(zero_copy_only=False)
            lengths = np.diff(np.frombuffer(batch.column(batch.schema.get_field_index("bytes")).buffers()[1], np.int32)[:batch.num_rows + 1])
            at = 0
            last = held[-1].column("shard")[-1].as_py() if held else None
            total = size + np.cumsum(lengths)
            border = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
            for b in border.tolist():
                new = b > 0 or (last is not None and shard[0] != last)
                if new and (total[b - 1] if b else size) >= block:
                    if b > at:
                        held.append(batch.slice(at, b - at))
                    yield from solve(held, waiting)
                    held, at = [], b
                    total = total - (total[b - 1] if b else size)
                    size = 0
            if at < batch.num_rows:
                held.append(batch.slice(at))
            size = int(total[-1]) if batch.num_rows else size
        if held:
            yield from solve(held, waiting)
        for parts in waiting.values():
            yield from sort(parts)

    return regions.select("id", "row", "begin", "windows", "places", "bytes", "shard", "crowded").mapInArrow(run, FOUND)


def repeated_spans(docs: DataFrame, *, width: int = WIDTH, gram: int = GRAM, bits: int = FILTER_BITS, crowd: int = CROWD, block: int = BLOCK) -> DataFrame:
    """id, row, begin and end (bytes) of spans that go; they may overlap.
    ``docs`` as of :func:`keyed`."""
    spark = docs.sparkSession
    keys = spark.sparkContext.broadcast(bit_set(repeated_keys(docs, width, gram), bits, PROBES))
    regions = cut(regions_where(docs, lambda r, _: r.with_key_in(keys.value), width, gram), "regions")
    keys.unpersist()
    # equal content means equal anchors
    least = regions.groupBy("content").agg(F.min(F.struct("id", "begin")).alias("first"))
    least = cut(least.select("content", F.col("first.id").alias("first_id"), F.col("first.begin").alias("first_begin")), "first-regions")
    leads = (F.col("id") == F.col("first_id")) & (F.col("begin") == F.col("first_begin"))
    told = cut(regions.join(least, "content").select(*[F.when(leads, F.col(c)).alias(c) for c in ("anchor", "content")], "id", "row", "begin", "windows", "places"), "told")
    equal = told.filter("content IS NULL").select("id", "row", "begin", (F.col("begin") + F.col("windows") + width - 1).alias("end"))
    # the first of equal regions goes to the shards, if its anchor has others, or is in it again
    unlike = told.filter("content IS NOT NULL")
    sizes = cut(unlike.groupBy("anchor").agg(
        F.count("*").alias("n"), F.sum(F.col("windows") + width - 1).alias("size"), F.max("places").alias("places")).filter("n > 1 OR places > 1"), "sizes")
    open_ = unlike.join(sizes, "anchor", "left_semi")
    marks = spark.sparkContext.broadcast(bit_set(open_.select(mark("content", "id", "begin").alias("h")), bits, PROBES))
    shown = regions_where(docs, lambda r, ids: in_set(marks.value, mark(r.content, ids, r.begin), PROBES), width, gram, with_bytes=True)
    # few anchors are crowded; the planner broadcasts them if they are few enough
    crowds = cut(sizes.filter(F.col("size") > crowd).select("anchor", "size"), "crowds")
    dealt = shown.join(crowds, "anchor", "left").withColumn("crowded", F.col("size").isNotNull())
    parts = F.coalesce(F.ceil(F.col("size") / crowd), F.lit(1))
    dealt = dealt.withColumn("shard", F.xxhash64("anchor", F.pmod(F.xxhash64("content"), parts)))
    total = sizes.agg(F.sum("size")).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (4 * block)))
    dealt = dealt.repartition(tasks, "shard").sortWithinPartitions("shard")
    found = cut(sort_shards(dealt, width, block), "sorted")
    marks.unpersist()
    spans = found.filter("hash1 IS NULL").select("id", "row", "begin", "end")
    opened = found.filter("hash1 IS NOT NULL")
    both = ["hash1", "hash2"]
    across = opened.groupBy(*both).agg(F.min(F.struct("id", "begin")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    across = cut(across.select(*both, F.col("first.id").alias("first_id"), F.col("first.begin").alias("first_begin")), "across")
    late = opened.join(across, both).filter(~leads).select("id", "row", "begin", "end")
    return equal.union(spans).union(late)


def merge(spans: np.ndarray) -> np.ndarray:
    """Sorted (begin, end) rows without overlaps or seams."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    end = np.maximum.accumulate(spans[:, 1])
    new = np.append(True, spans[1:, 0] > end[:-1])
    head = np.flatnonzero(new)
    return np.stack((spans[head, 0], end[np.append(head[1:], len(spans)) - 1]), 1)


def cut_repeats(docs: DataFrame, *, width: int = WIDTH, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, and the kept bytes' sha256."""
    rows = keyed(docs)
    spans = repeated_spans(rows, width=width, **options)
    gathered = spans.groupBy("id", "row").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    gathered = gathered.select("id", "row", F.expr("transform(spans, s -> s.begin)").alias("begins"), F.expr("transform(spans, s -> s.end)").alias("ends"))
    schema = T.StructType([docs.schema["doc_id"], *_long("n_bytes", "n_removed", "n_spans"), T.StructField("kept_sha256", T.StringType())])

    def run(batches):
        for whole in batches:
            for part in slices(whole, "text"):
                col = dict(zip(part.schema.names, part.columns, strict=True))
                raw, off = utf8(col["text"])
                raw = raw.tobytes()
                out = []
                for i in range(part.num_rows):
                    text = raw[off[i]:off[i + 1]]
                    begins = col["begins"][i]
                    spans = merge(np.stack((begins.values.to_numpy(), col["ends"][i].values.to_numpy()), 1)) if begins.is_valid else np.zeros((0, 2), np.int64)
                    digest, at = hashlib.sha256(), 0
                    for a, b in spans.tolist():
                        digest.update(text[at:a])
                        at = b
                    digest.update(text[at:])
                    out.append((len(text), int((spans[:, 1] - spans[:, 0]).sum()), len(spans), digest.hexdigest()))
                made = [pa.array([r[k] for r in out], pa.int64() if k < 3 else pa.string()) for k in range(4)]
                yield pa.RecordBatch.from_arrays([col["doc_id"], *made], names=schema.fieldNames())

    joined = rows.join(gathered.hint("shuffle_hash"), ["id", "row"], "left")
    return joined.select("doc_id", "text", "begins", "ends").mapInArrow(run, schema)


@query("op10_suffix_array_dedup", oracles.SUBSTRINGS)
def op10_suffix_array_dedup(spark, sf_dir):
    return cut_repeats(documents(spark, sf_dir))
