"""Near-duplicate groups by SuperMinHash.

1. Every text gives its set of five-word shingles as 64-bit hashes, and a
   SuperMinHash signature of it: an element's rank in slot ``i`` is the place
   of ``i`` in the element's own permutation plus a fraction, so the ranks of
   an element are correlated and the estimate varies less.  Ranks are dealt
   in rounds; a text stops once no later round can lower a slot.
2. Texts with equal sets form a class, which gets a number of its own; ids
   come back in only at the end, so texts that share an id stay apart.
3. The signature is cut into bands; classes that agree in a band share a
   bucket.  With 32 bands of 4 a pair at the least similarity is missed with
   probability (1 - 0.75^4)^32 = 5e-6.
4. In each bucket all classes are compared with the smallest number (a star,
   no pairs), on full sets.  Union-find gives components.
5. Only buckets that then still hold several components can hide a link.
   They get stars with several other centres, all in one pass, which join
   nearly all of a large group: a class that stays out meets all of its group
   later.  The classes of the buckets that are left meet across
   components at the rare shingles of an exact prefix filter, and full sets
   decide each pair that it leaves.

Nothing is collected: sets, edges and labels stay in tables.  Joins with a
hot side are between written tables, so that AQE can split them; the sets are
recomputed for classes in shared buckets only, in a scan that a bit set of a
fixed size leads to their texts; texts are shuffled for them only once the
classes would fill that set.

Edge cases: null or empty text, or text without words, has no set, is linked
with nothing and kept; fewer than five words are one shingle.  A null doc_id
is linked with nothing and kept.  Rows with one doc_id are linked text by text.
An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindle.llm import oracles
from spindle.llm.common import FILTER_BITS, bit_set, cut, documents, in_set, map_text, slices, utf8
from spindle.llm.registry import query

WORDS, SLOTS, BANDS = 5, 128, 32
PERCENT = 75
#: Draws of other centres in each bucket, and centres of a draw, before prefixes settle what is left; more leave less, none changes the
#: result.  All draws are compared and joined at once: a pass costs some twenty jobs, however few links it finds.
ROUNDS, CENTRES = 2, 3
#: Sets meet by size class, each this much larger than the one before.
SIZE_STEP = 1.05

#: Classes whose texts a broadcast bit set can find; more would let nearly all texts through, so that theirs are joined by id.
BROADCAST_IDS = FILTER_BITS

#: Bytes of text hashed at once: a shingle takes up to 400 bytes while its slots are drawn.  Steps four times
#: as large take a tenth less time and 36 MB more of each Python worker.
STEP_BYTES = 1 << 18

#: Nodes of a union-find in one task, of about 200 bytes each.
FOREST_NODES = 1 << 18

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_RANDOM = np.random.Generator(np.random.PCG64(20240229))
BYTE_VALUE = _RANDOM.integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
PLACE_VALUE = _RANDOM.integers(1, 1 << 63, 16, np.uint64) | np.uint64(1)
BASE = int(_RANDOM.integers(1, 1 << 62)) * 2 + 1
_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every bit of the input moves every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2^64, at least ``n``."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n + (n >> 2), STEP_BYTES)
        _POWERS[:] = []
        for factor in (BASE, pow(BASE, -1, 1 << 64)):
            p = np.full(size, np.uint64(factor))
            p[0] = 1
            _POWERS.append(np.multiply.accumulate(p))
    return _POWERS[0], _POWERS[1]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word (A-Z in lower case, split at ASCII white space) of
    all texts in a row, and where each text's words start."""
    raw, off = utf8(texts)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    upper = (raw >= 65) & (raw <= 90)
    raw = raw + upper.astype(np.uint8) * np.uint8(32)
    n = len(raw)
    begin = ~space
    begin[1:] &= space[:-1]
    firsts = off[:-1][off[:-1] < off[1:]]
    begin[firsts] = ~space[firsts]
    stop = ~space
    stop[:-1] &= space[1:]
    lasts = off[1:][off[:-1] < off[1:]] - 1
    stop[lasts] = ~space[lasts]
    start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    power, inverse = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_VALUE[raw] * power[:n], out=sums[1:])
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64)), np.searchsorted(start, off)


def shingle_sets(texts: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each text."""
    hashes, places = word_hashes(texts)
    n = len(hashes)
    if n >= words:
        runs = sum(hashes[k:n - words + 1 + k] * PLACE_VALUE[k] for k in range(words))
        runs = mix(runs)
    out = []
    for a, b in zip(places.tolist(), places[1:].tolist(), strict=False):
        if b - a >= words:
            out.append(np.unique(runs[a:b - words + 1]))
        elif b > a:
            whole = int((hashes[a:b] * PLACE_VALUE[:b - a]).sum(dtype=np.uint64)) + (b - a) * int(PLACE_VALUE[15])
            out.append(mix(np.array([whole % (1 << 64)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def superminhash(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """One signature for each set; rows of empty sets stay infinite.

    Round ``j`` draws each element's ``j``-th slot (a step of a Fisher-Yates
    shuffle seeded by the element) and a fraction, and lowers that slot to
    ``j`` plus the fraction.  A set is done when all its slots are below
    ``j + 1``.
    """
    n = len(sets)
    low = np.full(n * slots, np.inf)
    sizes = np.array([len(s) for s in sets])
    element = np.concatenate([*sets, np.zeros(0, np.uint64)])
    owner = np.repeat(np.arange(n), sizes)
    drawn: list[np.ndarray] = []
    for j in range(slots):
        if not len(element):
            break
        r = mix(element + np.uint64(int(GOLDEN) * (j + 1) % (1 << 64)))
        k = j + (((r & np.uint64(0xFFFFFFFF)) * np.uint64(slots - j)) >> np.uint64(32)).astype(np.int16)
        slot = k.copy()
        for t in range(j - 1, -1, -1):  # where that slot stood before the earlier steps
            slot[slot == drawn[t]] = t
        np.minimum.at(low, owner * slots + slot, j + (r >> np.uint64(32)).astype(np.float64) / 4294967296.0)
        drawn.append(k)
        open_sets = low.reshape(n, slots).max(1) >= j + 1
        stay = open_sets[owner]
        if not stay.all():
            element, owner = element[stay], owner[stay]
            drawn = [d[stay] for d in drawn]
    return low.reshape(n, slots)


def band_keys(signatures: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One key for each band, which also says which band it is."""
    n, slots = signatures.shape
    bits = np.ascontiguousarray(signatures).view(np.uint64).reshape(n, bands, slots // bands)
    key = np.arange(1, bands + 1, dtype=np.uint64)[None, :] * GOLDEN
    for i in range(slots // bands):
        key = mix(key + bits[:, :, i] * PLACE_VALUE[i])
    return key.view(np.int64)


KEY = ("n_shingles", "fp1", "fp2")
_LONGS = T.ArrayType(T.LongType())


def fingerprints(sets: list[np.ndarray]) -> list:
    """Size and 128 bits of each set."""
    fp1 = np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
    fp2 = np.array([np.bitwise_xor.reduce(mix(s * PLACE_VALUE[9]), initial=np.uint64(0)) for s in sets], np.uint64).view(np.int64)
    return [pa.array([len(s) for s in sets], pa.int64()), pa.array(fp1), pa.array(fp2)]


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, the fingerprint of the set (fp1, fp2) and bands."""
    def make():
        def sign(texts):
            sets = shingle_sets(texts)
            keys = band_keys(superminhash(sets))
            return [*fingerprints(sets), pa.array([k if len(s) else None for k, s in zip(list(keys), sets, strict=True)], pa.list_(pa.int64()))]

        return sign

    return map_text(docs, [*(T.StructField(k, T.LongType()) for k in KEY), T.StructField("bands", _LONGS)], make, limit=STEP_BYTES)


def sets_of(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """rep and the set (items) of each of ``classes`` (rep, low, fingerprint):
    texts whose id may be the ``low`` of a class are hashed again, and the
    fingerprint tells which are."""
    marks = None
    if classes.count() <= BROADCAST_IDS:
        marks = docs.sparkSession.sparkContext.broadcast(bit_set(classes.select(F.xxhash64("low").alias("h"))))
    else:
        docs = docs.join(classes.select(F.col("low").alias("doc_id")), "doc_id", "left_semi")

    def run(batches):
        for whole in batches:
            some = whole if marks is None else whole.filter(pa.array(in_set(marks.value, whole.column(1).to_numpy())))
            for part in slices(some, "text", STEP_BYTES):
                sets = shingle_sets(part.column(0))
                items = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*fingerprints(sets), items], names=[*KEY, "items"])

    schema = T.StructType([*(T.StructField(k, T.LongType()) for k in KEY), T.StructField("items", _LONGS)])
    found = docs.select("text", F.xxhash64("doc_id").alias("h")).mapInArrow(run, schema)
    return found.dropDuplicates(list(KEY)).join(classes.select("rep", *KEY), list(KEY)).select("rep", "items")


def _close(shared, a, b, percent: int):
    return F.lit(100) * shared >= F.lit(percent) * (a + b - shared)


def verify(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``pairs`` (a, b) with their exact ``distance`` and whether they are
    ``linked``, on full sets."""
    left = sets.select(F.col("rep").alias("a"), F.col("items").alias("items_a"))
    right = sets.select(F.col("rep").alias("b"), F.col("items").alias("items_b"))
    shared = F.size(F.array_intersect("items_a", "items_b"))
    both = pairs.join(left, "a").join(right, "b").withColumn("_shared", shared)
    a, b = F.size("items_a"), F.size("items_b")
    far = 1 - F.col("_shared") / (a + b - F.col("_shared"))
    return both.select(*pairs.columns, far.alias("distance"), _close(F.col("_shared"), a, b, percent).alias("linked"))


def forest(edges: DataFrame) -> DataFrame:
    """Union-find within each partition: (a, b) edges become (node, root)."""

    def run(parts):
        root: dict[int, int] = {}

        def find(x):
            while root.setdefault(x, x) != x:
                root[x] = x = root[root[x]]
            return x

        def known():
            nodes = list(root)
            return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], names=["a", "b"])

        for part in parts:
            for a, b in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                a, b = find(a), find(b)
                root[max(a, b)] = min(a, b)
            if len(root) >= FOREST_NODES:  # bounded memory: what is known so far goes out as it is
                yield known()
                root.clear()
        yield known()

    return edges.select(F.col("a").cast("long"), F.col("b").cast("long")).mapInArrow(run, "a long, b long").filter("a != b")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): the smallest node
    that can be reached.  Labels go along edges, then along labels, until none
    changes; every round is a written table."""
    half = forest(edges)
    ways = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    both = cut(half.select(ways.alias("way")).select("way.a", "way.b").distinct(), "edges")
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        seen = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("m"))
        hooked = cut(labels.join(seen, labels["node"] == seen["a"]).select("node", F.least("label", "m").alias("label"), F.col("label").alias("old")), "labels")
        up = hooked.select(F.col("node").alias("label"), F.col("label").alias("higher"))
        jumped = cut(hooked.join(up, "label").select("node", "higher", "old"), "labels")
        labels = jumped.select("node", F.col("higher").alias("label"))
        if jumped.filter("higher != old").isEmpty():
            return labels


def unsettled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """key, rep, n and label of the ``rows`` (key, rep, n) whose bucket holds
    several labels, and the label of most of its classes (top); no link is
    missing in the others."""
    named = labels.withColumnRenamed("node", "rep")
    spots = cut(rows.select("key", "rep", "n").join(named, "rep", "left").withColumn("label", F.coalesce("label", "rep")), "spots")
    mixed = _across(spots, "key").select("key", "top")
    return cut(spots.join(cut(mixed, "mixed"), "key"), "spots")


def fresh_star(spots: DataFrame, turn: int, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) of each class of ``spots`` outside the label of most of its
    bucket with the classes of the bucket that the hashes of ``turn`` pick,
    unless label or size rules them out.  A large group meets no outsider's
    star that way: it is the outsider that meets the group's."""
    draws = range(turn * CENTRES, (turn + 1) * CENTRES)
    picked = [F.min(F.struct(F.xxhash64("rep", F.lit(k)).alias("draw"), "rep", "label", "n")).dropFields("draw") for k in draws]
    drawn = spots.groupBy("key").agg(F.array_distinct(F.array(*picked)).alias("some")).select("key", F.explode("some").alias("c"))
    centres = cut(drawn.select("key", "c.rep", "c.label", "c.n").toDF("key", "b", "label_b", "n_b"), "centres")
    met = spots.filter("label != top").join(centres, "key").filter(F.col("label") != F.col("label_b")).filter(_sized(F.col("n"), F.col("n_b"), percent))
    return met.select(F.col("rep").alias("a"), "b").distinct()


def _sized(a, b, percent: int):
    return F.lit(100) * F.least(a, b) >= F.lit(percent) * F.greatest(a, b)


def _across(rows: DataFrame, *key: str) -> DataFrame:
    """``key``, how many of ``rows`` have it (total), the label of most of them
    (top) and the count of the others, for the keys of several labels.  Counts
    are added by key and label first, so a hot key moves few rows."""
    each = rows.groupBy(*key, "label").agg(F.count("*").alias("k"))
    found = each.groupBy(*key).agg(F.sum("k").alias("total"), F.max(F.struct("k", "label")).alias("most"), F.count("*").alias("labels"))
    return found.filter("labels > 1").select(*key, "total", F.col("most.label").alias("top"), (F.col("total") - F.col("most.k")).alias("others"))


def prefixes(spots: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Items by which a class of ``spots`` can be linked with one of another
    label: rep, n, label, its size class (z), the other's (w), the number of
    the class's items (c), an item and its place among them.

    Only items of several labels can be shared across labels.  Linked classes
    share ``percent / (100 + percent)`` of both sizes, so the first of their
    common items, in any one order, is among the first ``c - needed + 1`` of
    both; the order puts items of few pairs first."""
    classes = spots.select("rep", "n", "label").distinct()
    rows = cut(classes.join(sets, "rep"), "open").select("rep", "n", "label", F.explode("items").alias("item"))
    weighed = cut(_across(rows, "item").select("item", (F.col("total") * F.col("others")).alias("cost")), "across")
    own = rows.join(weighed, "item").groupBy("rep", "n", "label").agg(F.sort_array(F.collect_list(F.struct("cost", "item"))).alias("own"))
    own = own.withColumn("c", F.size("own")).filter(F.lit(100) * F.col("c") >= F.lit(percent) * F.col("n"))
    size_class = lambda x: F.floor(F.log(x) / F.log(F.lit(SIZE_STEP))).cast("int")
    n = F.col("n").cast("double")
    own = own.withColumn("z", size_class(n)).withColumn("w", F.explode(F.sequence(size_class(F.ceil(n * percent / 100)), size_class(F.floor(n * 100 / percent)))))
    least = F.greatest(F.ceil(F.pow(F.lit(SIZE_STEP), F.col("w")) * (1 - 1e-9)), F.ceil(n * percent / 100))  # the other's size
    needed = F.ceil((n + least) * percent / (100 + percent) - 1e-6).cast("int")
    own = own.withColumn("first", F.col("c") - needed + 1).filter("first > 0")
    return own.select("rep", "n", "label", "c", "z", "w", F.posexplode(F.slice("own", F.lit(1), F.col("first"))).alias("place", "x")).withColumn("item", F.col("x.item")).drop("x")


def candidates(spots: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) of classes of ``spots`` with different labels, among them
    every link.

    Classes meet at an item of both their prefixes, as ids, sizes and places.
    The classes of the label that has most of an item are on one side only, so
    they never meet each other.  Size and place rule out more pairs."""
    key = ["item", "low", "high"]
    rows = prefixes(spots, sets, percent).withColumn("low", F.least("z", "w")).withColumn("high", F.greatest("z", "w"))
    rows = cut(rows, "prefixes")
    rows = cut(rows.join(cut(_across(rows, *key).select(*key, "top"), "tops"), key), "postings")
    x, y = rows.filter("label != top").alias("x"), rows.alias("y")
    most = F.least(F.col("x.c") - F.col("x.place"), F.col("y.c") - F.col("y.place"))  # common items from here on; places count from 0
    met = ((F.col("x.item") == F.col("y.item")) & (F.col("x.z") == F.col("y.w")) & (F.col("x.w") == F.col("y.z")) & (F.col("x.label") != F.col("y.label"))
           & ((F.col("y.label") == F.col("y.top")) | (F.col("x.rep") > F.col("y.rep"))))
    able = _sized(F.col("x.n"), F.col("y.n"), percent) & _close(most, F.col("x.n"), F.col("y.n"), percent)
    return x.join(y, met & able).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct()


def groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, the fingerprint, component_id and kept of each row."""
    signed = cut(signatures(docs), "signatures")
    usable = signed.filter("doc_id IS NOT NULL AND n_shingles > 0")
    key = list(KEY)
    classes = cut(usable.groupBy(*key).agg(F.min("doc_id").alias("low"), F.min(F.struct("doc_id", "bands"))["bands"].alias("bands"))
                  .withColumn("rep", F.monotonically_increasing_id()), "classes")

    banded = classes.select("rep", F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    buckets = cut(banded.groupBy("key").agg(F.min("rep").alias("centre"), F.max("rep").alias("most"), F.count("*").alias("size")).filter("centre < most").drop("most"), "buckets")
    shared = cut(banded.join(buckets, "key"), "shared")
    star = shared.filter("rep != centre").select(F.col("rep").alias("a"), F.col("centre").alias("b")).distinct()
    star = cut(star, "star")
    met = star.select(F.col("a").alias("rep")).union(star.select(F.col("b").alias("rep"))).distinct()
    sets = cut(sets_of(docs, cut(classes.drop("bands").join(met, "rep", "left_semi"), "met")), "sets")
    checked = cut(verify(star, sets, percent), "checked")
    links = checked.filter("linked").select("a", "b")
    labels = components(links)

    spots = unsettled(shared.filter("size > 2"), labels)
    settled = spots.isEmpty()
    if not settled:
        stars = [fresh_star(spots, turn, percent) for turn in range(ROUNDS)]
        pairs = reduce(DataFrame.union, stars).distinct()
        more = cut(verify(pairs, sets, percent).filter("linked").select("a", "b"), "more")
        if not more.isEmpty():
            links = links.union(more)
            labels = components(links)
            spots = unsettled(spots, labels)
            settled = spots.isEmpty()
    if not settled:
        pairs = cut(candidates(spots, sets, percent), "pairs")
        more = cut(verify(pairs, sets, percent).filter("linked").select("a", "b"), "more")
        if not more.isEmpty():
            labels = components(links.union(more))

    # the smallest id of a component, by classes first, so that a large group is few rows
    named = classes.select("rep", "low", *key).join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    named = cut(named, "named")
    least = named.groupBy("label").agg(F.min("low").alias("component_id"))
    named = cut(named.join(least, "label").select(*key, "component_id"), "components")
    grouped = usable.select("doc_id", *key).join(named, key).select("doc_id", *key, "component_id")
    alone = signed.filter("doc_id IS NULL OR n_shingles = 0").select("doc_id", *key, F.col("doc_id").alias("component_id"))
    return grouped.union(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def near_duplicates(docs: DataFrame, *, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each document."""
    return groups(docs, percent).select("doc_id", "n_shingles", "component_id", "kept")


def drop_near_duplicates(docs: DataFrame, *, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group.  Of rows with one doc_id those
    stay whose text is kept, and one of equal ones.

    Ids that lose a row are looked up in a bit set; only rows that it lets
    through are told apart exactly, by id and fingerprint."""
    found = cut(groups(docs, percent).filter("doc_id IS NOT NULL").select("doc_id", *KEY, "kept"), "found")
    touched = cut(found.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("kept").alias("kept")).filter("n > 1 OR NOT kept").select("doc_id"), "touched")
    marks = docs.sparkSession.sparkContext.broadcast(bit_set(touched.select(F.xxhash64("doc_id").alias("h"))))
    columns = docs.columns

    @F.arrow_udf("boolean")
    def marked(hashes: pa.Array) -> pa.Array:
        return pa.array(in_set(marks.value, hashes.to_numpy()))

    maybe = marked(F.xxhash64("doc_id"))  # only the hash goes to Python, no text
    whole = docs.filter(~maybe)
    part = docs.filter(maybe)
    gone = found.groupBy("doc_id").agg(F.max("kept").alias("any")).filter("NOT any").select("doc_id")
    left = part.join(gone, "doc_id", "left_anti").select(*columns)
    again = cut(found.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id"), "again")
    if again.isEmpty():
        return whole.union(left)
    once = left.join(again, "doc_id", "left_anti").select(*columns)
    return whole.union(once).union(_told_apart(left.join(again, "doc_id", "left_semi").select(*columns), found))


def _told_apart(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Of rows with repeated ids, one for each kept text."""
    columns, names = rows.columns, [f"_{k}" for k in KEY]
    schema = T.StructType([*rows.schema.fields, *(T.StructField(n, T.LongType()) for n in names)])

    def run(batches):
        for whole in batches:
            for part in slices(whole, "text", STEP_BYTES):
                marks = fingerprints(shingle_sets(part.column(part.schema.get_field_index("text"))))
                yield pa.RecordBatch.from_arrays([*part.columns, *marks], names=schema.fieldNames())

    kept = found.filter("kept").select("doc_id", *[F.col(k).alias(n) for k, n in zip(KEY, names, strict=True)]).distinct()
    marked = rows.mapInArrow(run, schema)
    return marked.join(kept, ["doc_id", *names], "left_semi").dropDuplicates(["doc_id", *names]).select(*columns)


@query("op7_minhash_near_dedup", oracles.NEAR_DEDUP)
def op7_minhash_near_dedup(spark, sf_dir):
    return near_duplicates(documents(spark, sf_dir))
