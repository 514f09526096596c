"""Benchmark decontamination: a broadcast hash set of normalised n-grams.

Text is lower-cased (A-Z) and cut into words of ASCII letters, digits and
non-ASCII characters.  A window is ``width`` consecutive words of an item; an
item with fewer words, but not none, is one window.  Documents are scanned
once: words become numbers of the items' vocabulary, and only runs of known
words that are long enough are looked up, by the whole window, so every hit
is verified exactly.

The set is broadcast while its windows number at most ``max_windows``.
Beyond that the items are dealt by a hash into parts of that size and the
documents pass each part in turn, with the hits so far in a bit mask that
is written between passes: nothing is dropped at any size.

Edge cases: null or wordless text has no words and no hits; items without
words are ignored; an item id that occurs in several rows counts once; a
null item id is the empty string; empty tables give no hits or no rows;
repeated documents are marked one by one.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindle.llm import oracles
from spindle.llm.common import cut, documents, filter_text, slices
from spindle.llm.registry import query
from spindle.session import read_table

_WORD = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
#: Byte to byte: A-Z in lower case, word bytes as they are, the rest a space.
NORMAL = bytes(b if b in _WORD else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(NORMAL).split()


class Windows:
    """The windows of some items, ready to be broadcast."""

    def __init__(self, items: list[tuple[str, str | None]], width: int):
        self.ids = sorted({i for i, _ in items})
        number = {i: k for k, i in enumerate(self.ids)}
        self.vocabulary: dict[bytes, int] = {}
        self.windows: dict[bytes, list[int]] = {}
        lengths = set()
        for item, text in items:
            words = words_of(text)
            if not words:
                continue
            seq = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], np.int32)
            n = min(width, len(seq))
            lengths.add(n)
            for i in range(len(seq) - n + 1):
                known = self.windows.setdefault(seq[i:i + n].tobytes(), [])
                if number[item] not in known:
                    known.append(number[item])
        self.lengths = sorted(lengths)

    def hits(self, text: str | None) -> tuple[np.ndarray, set[int]]:
        """Which words are hit, and the numbers of the items that occur."""
        words = words_of(text)
        hit = np.zeros(len(words), bool)
        found: set[int] = set()
        if not self.lengths or len(words) < self.lengths[0]:
            return hit, found
        seq = np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int32, len(words))
        known = np.concatenate(([0], np.cumsum(seq > 0, dtype=np.int32)))
        for n in self.lengths:
            for i in np.flatnonzero(known[n:] - known[:-n] == n).tolist() if len(words) >= n else ():
                items = self.windows.get(seq[i:i + n].tobytes())
                if items is not None:
                    hit[i:i + n] = True
                    found.update(items)
        return hit, found


def _parts(benchmark: DataFrame, width: int, max_windows: int) -> list[list[tuple[str, str | None]]]:
    """The items in lists of about ``max_windows`` windows; one, if all fit.
    An upper bound of the windows comes from one aggregate: words take two
    bytes each, one and a gap."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text"))
    size = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n = max(1, -(-size // (2 * max_windows)))
    for k in range(n):
        part = items if n == 1 else items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        yield [(r["item"], r["text"]) for r in part.collect()]


FIELDS = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
          T.StructField("hits", T.BinaryType()), T.StructField("items", T.ArrayType(T.StringType()))]


def mark_windows(docs: DataFrame, benchmark: DataFrame, *, width: int = 10, max_windows: int = 400_000,
                 keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """For each document: ``n_words``, ``n_hit``, ``hits`` (one byte for each
    word, 1 if an occurring window covers it) and ``items`` (occurring ids,
    sorted).  ``keep`` names the columns that go through."""
    spark = docs.sparkSession
    state = docs.select(*dict.fromkeys([*keep, "text"]))
    for k, part in enumerate(_parts(benchmark, width, max_windows)):
        if k:
            state = cut(state.withColumnsRenamed({"hits": "_hits", "items": "_items"}), "decontaminate")
        state = _scan(state, spark.sparkContext.broadcast(Windows(part, width)), keep)
    return state.select(*keep, *(f.name for f in FIELDS))


def _scan(docs: DataFrame, shared, keep: tuple[str, ...]) -> DataFrame:
    """One pass; adds to the marks of earlier passes, if ``docs`` has them."""
    earlier = ["_hits", "_items"] if "_hits" in docs.columns else []
    names = list(dict.fromkeys([*keep, "text"]))
    schema = T.StructType([docs.schema[k] for k in names] + FIELDS)

    def run(batches):
        win = shared.value
        for whole in batches:
            for part in slices(whole, "text"):
                col = dict(zip(part.schema.names, part.columns, strict=True))
                marks, items = [], []
                for i, text in enumerate(col["text"].to_pylist()):
                    hit, found = win.hits(text)
                    ids = {win.ids[k] for k in found}
                    if earlier:
                        hit = hit | (np.frombuffer(col["_hits"][i].as_py(), np.uint8) > 0)
                        ids |= set(col["_items"][i].as_py())
                    marks.append(hit)
                    items.append(sorted(ids))
                made = [pa.array([len(m) for m in marks], pa.int64()), pa.array([int(m.sum()) for m in marks], pa.int64()),
                        pa.array([m.tobytes() for m in marks], pa.binary()), pa.array(items, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*(col[k] for k in names), *made], names=schema.fieldNames())

    return docs.select(*names, *earlier).mapInArrow(run, schema)


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """What :func:`mark_windows` finds, as counts and a digest of the items."""
    ids = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return mark_windows(docs, benchmark, **options).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), ids.alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def remove_documents(docs: DataFrame, benchmark: DataFrame, *, width: int = 10, max_windows: int = 400_000) -> DataFrame:
    """The documents that no window of the benchmark occurs in."""
    for part in _parts(benchmark, width, max_windows):
        shared = docs.sparkSession.sparkContext.broadcast(Windows(part, width))

        def make(shared=shared):
            return lambda texts: [not shared.value.hits(t)[1] for t in texts.to_pylist()]

        docs = filter_text(docs, make)
    return docs


def remove_spans(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """All documents; hit words, and what stands between two of them, go."""
    columns, schema = docs.columns, docs.schema
    text = columns.index("text")
    names = [f"c{i}" if i != text else "text" for i in range(len(columns))]
    marked = mark_windows(docs.toDF(*names), benchmark, keep=tuple(names), **options).select(*names, "n_hit", "hits")

    def run(batches):
        for batch in batches:
            rows = zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("text", "n_hit", "hits")), strict=True)
            texts = pa.array([_without(t, h) if n else t for t, n, h in rows], pa.string())
            cols = [texts if i == text else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(cols, names=columns)

    return marked.mapInArrow(run, schema)


def _without(text: str, hits: bytes) -> str:
    raw = text.encode()
    places = [m.span() for m in re.finditer(rb"[^ ]+", raw.translate(NORMAL))]
    out, at = [], 0
    for m in re.finditer(b"\x01+", hits):
        out.append(raw[at:places[m.start()][0]])
        at = places[m.end() - 1][1]
    return b"".join([*out, raw[at:]]).decode()


@query("op3_benchmark_decontamination", oracles.DECONTAMINATION)
def op3_benchmark_decontamination(spark, sf_dir):
    return contamination(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))
