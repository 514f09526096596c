"""Best-fit packing of token sequences by a configuration linear program.

1. Texts are tokenized in Arrow batches and cut into pieces; only a
   document's ids, lengths and checksums leave the task.
2. The histogram of lengths (at most ``size`` numbers, whatever the corpus)
   is packed on the driver.  A configuration is a set of lengths that fits
   a sequence.  Multiplicative weights give every length a price that rises
   while it lags behind in coverage; a knapsack dynamic programme over the
   capacity prices configurations, for each length the best that holds it.
   The averaged solution is rounded down, what is left is priced and
   rounded again, and the last few pieces go by best fit.  The prices also
   give a lower bound; while the plan is more than ``GAP`` above it, longer
   runs follow, and the best of all plans, plain best fit among them, is
   taken.
3. Each piece gets its rank among those of its length (ranks within hash
   buckets plus the buckets' running totals, so a length that a third of
   all pieces have is spread over all tasks).  Length and rank give
   sequence and offset by a binary search in the broadcast plan, whose
   size depends on ``size``, not on the rows.

Edge cases: null text is empty, and has the end id alone.  Repeated rows are
packed one by one, also with equal ids; their order is any.  A null doc_id
is kept.  An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindle.llm.common import cut, documents, slices
from spindle.llm.registry import query

SIZE, END_ID = 2048, 0
#: How far above the lower bound, as a share, a plan may stay without more rounds.
GAP = 1e-3
SPECIAL = "<|endoftext|>"


# --- tokens


def vocabulary(path: str | None = None) -> tuple[dict[bytes, int], str]:
    """Ranks and pre-token pattern of the byte-level vocabulary."""
    import public_tokenizers

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, public_tokenizers.PATTERN


class Encoder:
    """Ids of whole texts; a special token's string in a text is that token."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import tiktoken

        self.encode = tiktoken.Encoding("text", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.special = np.array([len(ranks)], "<u4").tobytes()

    def ids(self, text: str | None) -> bytes:
        """Ids as little-endian bytes, without an end id."""
        return self.special.join(np.array(self.encode(t), "<u4").tobytes() for t in (text or "").split(SPECIAL))


_ENCODERS: dict[int, Encoder] = {}


def _encoder(shared) -> Encoder:
    """One encoder for a Python worker; it outlives the task."""
    key = hash(shared)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(*shared.value)
    return _ENCODERS[key]


def cut_points(length: int, size: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces; all but the first have ``size`` tokens."""
    first = length % size or min(length, size)
    borders = [0, *range(first, length + 1, size)]
    return list(zip(borders, borders[1:], strict=False))


def tokenize(docs: DataFrame, *, size: int = SIZE, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece."""
    ranks, pattern = vocabulary(path)
    shared = docs.sparkSession.sparkContext.broadcast((ranks, pattern))
    names = ("piece", "start", "length", "ids_crc32")
    schema = T.StructType([docs.schema["doc_id"], T.StructField("piece", T.IntegerType()), *(T.StructField(n, T.LongType()) for n in names[1:])])
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encoder = _encoder(shared)
        for whole in batches:
            for part in slices(whole, "text"):
                owner, rows = [], []
                for i, text in enumerate(part.column("text").to_pylist()):
                    ids = encoder.ids(text) + end
                    for k, (a, b) in enumerate(cut_points(len(ids) // 4, size)):
                        owner.append(i)
                        rows.append((k, a, b - a, zlib.crc32(ids[4 * a:4 * b])))
                made = [pa.array([r[j] for r in rows], pa.int32() if j == 0 else pa.int64()) for j in range(4)]
                doc = part.column("doc_id").take(pa.array(owner, pa.int64()))
                yield pa.RecordBatch.from_arrays([doc, *made], names=schema.fieldNames())

    return docs.select("doc_id", "text").mapInArrow(run, schema)


# --- the plan


def knapsack(sizes: np.ndarray, price: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value of each capacity, repeats allowed, and the last size taken
    (0: none; the best of a smaller capacity)."""
    value, taken = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        value[c] = value[c - 1]
        k = np.searchsorted(sizes, c, "right")
        if k:
            offers = value[c - sizes[:k]] + price[:k]
            j = int(offers.argmax())
            if offers[j] > value[c] + 1e-12:
                value[c], taken[c] = offers[j], sizes[j]
    return value, taken


def best_with(size: int, taken: np.ndarray, capacity: int) -> tuple[int, ...]:
    """The configuration of ``size`` and the best rest, longest first."""
    out, left = [size], capacity - size
    while left > 0:
        if taken[left]:
            out.append(int(taken[left]))
            left -= int(taken[left])
        else:
            left -= 1
    return tuple(sorted(out, reverse=True))


def _uses(config: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    kinds, times = np.unique(config, return_counts=True)
    return kinds, times


def solve(demand: np.ndarray, capacity: int, *, rounds: int = 24, rate: float = 1.0) -> dict[tuple[int, ...], float]:
    """Fractional configurations that cover ``demand`` (by length), by
    multiplicative weights.  In a round each length asks for the best
    configuration that holds it, for an equal part of its demand that is
    still open; lengths ahead of the others get cheaper."""
    sizes = np.flatnonzero(demand)
    need = demand[sizes].astype(float)
    at = {int(s): i for i, s in enumerate(sizes)}
    weight, covered = np.ones(len(sizes)), np.zeros(len(sizes))
    found: dict[tuple[int, ...], float] = {}
    for r in range(rounds):
        _, taken = knapsack(sizes, sizes / capacity * weight, capacity)
        goal = need * (r + 1) / rounds
        for s in sizes[::-1].tolist():
            lack = goal[at[s]] - covered[at[s]]
            if lack <= 0:
                continue
            config = best_with(s, taken, capacity)
            kinds, times = _uses(config)
            k = [at[int(x)] for x in kinds]
            amount = min(lack / times[kinds == s][0], float(np.min((need[k] * 1.5 - covered[k]).clip(0) / times))) if len(k) > 1 else lack / times[0]
            if amount > 0:
                covered[k] += amount * times
                found[config] = found.get(config, 0.0) + amount
        weight *= np.exp(-rate * (covered / need - (r + 1) / rounds))
        weight = np.clip(weight / weight.mean(), 0.25, 4.0)
    return found


def play(demand: np.ndarray, capacity: int, *, rounds: int = 400, rate: float = 0.3) -> tuple[dict[tuple[int, ...], float], float]:
    """Fractional configurations that cover ``demand``, and a lower bound of
    the number of sequences.  Each round takes the configuration of the
    highest price; its lengths get cheaper by how much of their demand it
    covers.  Prices under which no configuration is worth more than v bound
    the number from below by all pieces' worth over v; that is tried with the
    prices of each round and with their mean."""
    sizes = np.flatnonzero(demand)
    need = demand[sizes].astype(float)
    at = {int(s): i for i, s in enumerate(sizes)}
    log_worth = np.log(sizes * need)
    mean, covered = np.zeros(len(sizes)), np.zeros(len(sizes))
    found: dict[tuple[int, ...], float] = {}
    bound = float(sizes @ need) / capacity

    def priced(worth):
        price = worth / need
        value, taken = knapsack(sizes, price / price.max(), capacity)
        return taken, worth.sum() / (value[capacity] * price.max())

    for r in range(rounds):
        worth = np.exp(log_worth - log_worth.max())
        worth /= worth.sum()
        mean += worth
        taken, below = priced(worth)
        bound = max(bound, below, priced(mean)[1] if r % 10 == 9 else 0.0)
        config = tuple(s for s in best_with(0, taken, capacity) if s)
        kinds, times = _uses(config)
        k = [at[int(x)] for x in kinds]
        share = times / need[k]
        amount = 1.0 / share.max()
        covered[k] += amount * share
        found[config] = found.get(config, 0.0) + amount
        log_worth[k] -= rate / np.sqrt(r + 1) * amount * share
    least = covered.min()
    return {c: a / least for c, a in found.items()} if least > 0 else {}, bound


def round_down(found: dict[tuple[int, ...], float], left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Whole numbers of the configurations, fullest first, within ``left``,
    which they are taken from."""
    out = []
    for config, amount in sorted(found.items(), key=lambda x: (-sum(x[0]), -x[1], x[0])):
        kinds, times = _uses(config)
        copies = int(min(np.floor(amount + 1e-9), (left[kinds] // times).min()))
        if copies > 0:
            left[kinds] -= copies * times
            out.append((config, copies))
    return out


def dive(left: np.ndarray, capacity: int, *, rounds: int = 40, full: float = 0.998) -> list[tuple[tuple[int, ...], int]]:
    """Price what is left and take whole configurations at once, until a
    round places little; lengths with more left are dearer."""
    out = []
    for _ in range(rounds):
        sizes = np.flatnonzero(left)
        before = int(left.sum())
        if before < 50:
            break
        share = left[sizes] / left[sizes].mean()
        _, taken = knapsack(sizes, sizes / capacity * (1 + 0.02 * np.log1p(share)), capacity)
        for s in sizes[::-1].tolist():
            if not left[s]:
                continue
            config = best_with(s, taken, capacity)
            if sum(config) < full * capacity:
                continue
            kinds, times = _uses(config)
            copies = int((left[kinds] // times).min())
            if copies > 0:
                left[kinds] -= copies * times
                out.append((config, copies))
        if left.sum() > 0.97 * before:
            break
    return out


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Longest first, each into the fullest sequence that has room; equal
    sequences are kept as one entry with a count, so a step moves many."""
    bins: dict[tuple[int, ...], int] = {}
    by_room: dict[int, list[tuple[int, ...]]] = {}

    def put(config, n):
        if config not in bins:
            by_room.setdefault(capacity - sum(config), []).append(config)
        bins[config] = bins.get(config, 0) + n

    rooms = np.zeros(capacity + 1, bool)
    for s in np.flatnonzero(left)[::-1].tolist():
        n = int(left[s])
        while n:
            fits = np.flatnonzero(rooms[s:])
            if not len(fits):
                each = capacity // s
                if n >= each:
                    put((s,) * each, n // each)
                if n % each:
                    put((s,) * (n % each), 1)
                n = 0
            else:
                room = s + int(fits[0])
                config = by_room[room].pop()
                have = bins.pop(config)
                k = min(n, have)
                if have > k:
                    put(config, have - k)
                put(config + (s,), k)
                n -= k
            for r in list(by_room):
                if not by_room[r]:
                    del by_room[r]
            rooms[:] = False
            rooms[list(by_room)] = True
    left[:] = 0
    return sorted(bins.items())


def _total(used: list[tuple[tuple[int, ...], int]]) -> int:
    return sum(n for _, n in used)


def _rounded(found: dict[tuple[int, ...], float], demand: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Whole configurations for all of ``demand``: ``found`` rounded down,
    the rest by the better of :func:`dive` and best fit."""
    left = demand.copy()
    whole = round_down(found, left, capacity)
    again = left.copy()
    ends = [dive(again, capacity) + best_fit(again, capacity), best_fit(left, capacity)]
    return whole + min(ends, key=_total)


def bounded_plan(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], int]:
    """Configurations and how often each is used, which hold every piece, and
    a number of sequences that no plan can go below."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    full = int(left[capacity])
    out = [((capacity,), full)] if full else []
    left[capacity] = 0
    if not left.any():
        return out, full
    bound = float(np.arange(capacity + 1) @ left) / capacity
    best = min(_rounded(solve(left, capacity), left, capacity), best_fit(left.copy(), capacity), key=_total)
    if _total(best) > np.ceil(bound * (1 + GAP)):
        found, better = play(left, capacity)
        bound = max(bound, better)
        best = min(best, _rounded(found, left, capacity), key=_total)
    return out + best, full + int(np.ceil(bound - 1e-6))


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Configurations and how often each is used; they hold every piece."""
    return bounded_plan(histogram, capacity)[0]


def slots(used: list[tuple[tuple[int, ...], int]], capacity: int) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: the ranks at which a configuration begins, how many pieces
    of the length it holds, its first sequence and the first one's offset."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for config, copies in used:
        offset = 0
        kinds, times = _uses(config)
        for s, m in zip(kinds.tolist()[::-1], times.tolist()[::-1], strict=True):
            rows.setdefault(s, []).append((ranks.get(s, 0), m, sequence, offset))
            ranks[s] = ranks.get(s, 0) + m * copies
            offset += s * m
        sequence += copies
    return {s: tuple(np.array(c, np.int64) for c in zip(*r, strict=True)) for s, r in rows.items()}


def pack(pieces: DataFrame, *, size: int = SIZE, buckets: int | None = None) -> DataFrame:
    """``pieces`` (as of :func:`tokenize`, written) with sequence_id and offset."""
    spark = pieces.sparkSession
    n = buckets or max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spread = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(n)).cast("int"))
    counts = spread.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    totals = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = spark.sparkContext.broadcast(slots(plan(totals, size), size))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece")
    ranked = (spread.withColumn("_k", F.row_number().over(within)).join(starts, ["length", "_bucket"])
              .withColumn("_rank", F.col("_before") + F.col("_k") - 1).select(*pieces.columns, "_rank"))
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches):
        where = table.value
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy(zero_copy_only=False)
            rank = batch.column(batch.schema.get_field_index("_rank")).to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for s in np.unique(length):
                mine = np.flatnonzero(length == s)
                first, times, base, start = where[int(s)]
                k = np.searchsorted(first, rank[mine], "right") - 1
                inside = rank[mine] - first[k]
                sequence[mine] = base[k] + inside // times[k]
                offset[mine] = start[k] + inside % times[k] * s
            cols = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(sequence), pa.array(offset)], names=schema.fieldNames())

    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, *, size: int = SIZE, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    return pack(cut(tokenize(docs, size=size, end_id=end_id, path=path), "pieces"), size=size)


@query("op5_best_fit_packing")
def op5_best_fit_packing(spark, sf_dir):
    return pack_documents(documents(spark, sf_dir))
