"""Language identification by cross-parsing entropy.

A suffix automaton is built from a bounded sample of labelled text of each
language.  A text is parsed greedily into the longest phrases that occur in
that language's sample; the language that needs the fewest phrases, each
weighed by the bits of a place in its sample and divided by the length, wins.

The automata are dense tables over letter classes, broadcast; all of them
take at most ``2 * all_chars * 64 * 4`` bytes, however many languages there
are.  All segments of a batch walk one table in step, so a character costs
one gather.  What a segment's first phrase lacks, as it began in the segment
before, is put right up to where both parses agree: the phrases are those of
one parse over the whole text.

Sample: ``docs_per_lang`` rows of each language in hash order (at most twice
as many), equal texts once, ``chars`` characters in all, fewer beyond
``all_chars / chars`` (10) languages.  Every sampled text
takes part: a text with more than its share of them gives windows spread over
its whole length, so that common beginnings do not fill the sample.

Edge cases: null text, or text without a letter, is ``und`` with score 0;
so is everything if no row is labelled.  Text of letters that no sample
has still gets the language with the lowest cost.  Ties go to the first
name in alphabetical order.  A null doc_id is held out.  Repeated rows get
equal results; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindle.llm.common import documents, map_text, remainder, sample_rows, utf8
from spindle.llm.registry import query

UNSEEN, CLASSES = 63, 64


def letter_classes(texts: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of each byte of the lower-cased texts, with runs of non-letters
    as one 0, and where each text starts."""
    raw, off = utf8(pc.utf8_lower(texts))
    cls = table[raw]
    stay = np.ones(len(cls), bool)
    stay[1:] = (cls[1:] != 0) | (cls[:-1] != 0)
    firsts = off[:-1][off[:-1] < off[1:]]
    stay[firsts] = True
    places = np.concatenate(([0], np.cumsum(stay)))[off]
    return cls[stay], places


def class_table(samples: list[str]) -> np.ndarray:
    """Byte to class: 0 for ASCII that is no letter, 1-26 for letters, then
    the non-ASCII bytes of the samples by frequency, UNSEEN for the rest."""
    table = np.zeros(256, np.uint8)
    table[0x61:0x7B] = np.arange(1, 27)
    table[0x80:] = UNSEEN
    counts = np.bincount(np.frombuffer("".join(samples).lower().encode(), np.uint8), minlength=256)[0x80:]
    common = [b for b in np.argsort(-counts, kind="stable")[:UNSEEN - 27] if counts[b]]
    table[0x80 + np.array(common, int)] = 27 + np.arange(len(common))
    return table


def suffix_automaton(seq: list[int]) -> np.ndarray:
    """Transitions of the suffix automaton of ``seq`` (-1: none)."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in seq:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    out = np.full((len(nxt), CLASSES), -1, np.int32)
    for state, edges in enumerate(nxt):
        for c, to in edges.items():
            out[state, c] = to
    return out


def parse_table(automaton: np.ndarray) -> np.ndarray:
    """One number for each state and class: the next state's row times 4, plus
    the phrases that end there.  Without a transition a phrase ends and the
    next begins with the class, or is that class alone."""
    root = automaton[0]
    fresh = np.where(root >= 0, root, 0)
    ends = np.where(root >= 0, 1, 2)[None, :].repeat(len(automaton), 0)
    ends[0] = np.where(root >= 0, 0, 1)
    to = np.where(automaton >= 0, automaton, fresh)
    return (to.astype(np.int32) * CLASSES * 4 + np.where(automaton >= 0, 0, ends)).astype(np.int32).ravel()


def carry(raw: bytes, table: np.ndarray, start: list[int], size: list[int], later: list[int], state: list[int], count: list[int]) -> None:
    """Phrases that end in each segment, and its last ``state``, as if the
    parse of the segment before went on.  ``later`` are the segments that are
    not their text's first, in order; they were parsed from state 0."""
    rows = memoryview(table)
    for g in later:
        a, b, more = 0, state[g - 1], 0
        for c in raw[start[g]:start[g] + size[g]]:
            if a == b:
                break
            x, y = rows[a + c], rows[b + c]
            more += (y & 3) - (x & 3)
            a, b = x >> 2, y >> 2
        if a != b:
            state[g] = b
        count[g] += more


def phrases(classes: np.ndarray, places: np.ndarray, tables: list[np.ndarray], segment: int) -> np.ndarray:
    """Phrases that each text needs (rows) by each table (columns)."""
    lengths = np.diff(places)
    n_seg = -(-lengths // segment)
    owner = np.repeat(np.arange(len(lengths)), n_seg)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(n_seg) - n_seg, n_seg)
    start = places[:-1][owner] + nth * segment
    size = np.minimum(segment, lengths[owner] - nth * segment)
    raw, later = classes.tobytes(), np.flatnonzero(nth).tolist()
    in_order = (start.tolist(), size.tolist(), later) if later else ()
    last = np.cumsum(n_seg)[n_seg > 0] - 1
    order = np.argsort(-size, kind="stable")
    start, size = start[order], size[order]
    out = np.zeros((len(lengths), len(tables)), np.int64)
    if not len(size):
        return out
    steps = int(size[0])
    live = np.searchsorted(-size, -np.arange(steps), "left")
    block = np.zeros((steps, len(size)), np.uint8)
    at = np.arange(steps)[:, None]
    for i in range(0, len(size), 4096):
        j = min(len(size), i + 4096)
        block[:, i:j] = classes[np.minimum(start[None, i:j] + at, len(classes) - 1)]
    for k, table in enumerate(tables):
        state = np.zeros(len(size), np.int32)
        count = np.zeros(len(size), np.int32)
        for t in range(steps):
            m = live[t]
            got = table.take(state[:m] + block[t, :m])
            count[:m] += got & 3
            np.right_shift(got, 2, out=state[:m])
        ends, total = np.empty_like(state), np.empty_like(count)
        ends[order], total[order] = state, count
        if later:
            at_end, found = ends.tolist(), total.tolist()
            carry(raw, table, *in_order, at_end, found)
            ends, total = np.array(at_end), np.array(found)
        total[last] += ends[last] > 0
        out[:, k] = np.bincount(owner, total, len(lengths)).astype(np.int64)
    return out


#: Characters of a window of a long training text.
WINDOW = 250


def excerpt(text: str, room: int) -> str:
    """``text``, or windows at even distances over all of it that fit ``room``."""
    if len(text) <= room:
        return text
    n = max(1, room // (WINDOW + 1))
    size = min(room, WINDOW)
    starts = [(len(text) - size) * (2 * i + 1) // (2 * n) for i in range(n)]
    return " ".join(text[a:a + size] for a in starts)


def training_text(texts: list[str], chars: int) -> str:
    """At most ``chars`` characters of all different ``texts``; what short
    texts leave goes to the longer ones."""
    different = sorted(dict.fromkeys(texts), key=lambda t: (len(t), t))
    out, left = [], chars
    for i, text in enumerate(different):
        out.append(excerpt(text, max(left // (len(different) - i) - 1, 0)))
        left -= len(out[-1]) + 1
    return " ".join(t for t in out if t)


def fit(train: DataFrame, *, label: str = "lang", docs_per_lang: int = 60, chars: int = 40_000, all_chars: int = 400_000) -> dict:
    """The model, from rows with text and a label; see the module for bounds."""
    usable = train.select("doc_id", "text", F.col(label).alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")
    texts: dict[str, list[str]] = {}
    for r in sample_rows(usable, "lang", docs_per_lang, "doc_id", "text").collect():
        texts.setdefault(r["lang"], []).append(r["text"])
    langs = sorted(k for k, v in texts.items() if any(c.isalpha() for t in v for c in t))
    room = min(chars, all_chars // max(1, len(langs)))
    joined = {k: training_text(texts[k], room) for k in langs}
    table = class_table(list(joined.values()))
    tables, bits = [], []
    for k in langs:
        seq, _ = letter_classes(pa.array([joined[k]]), table)
        tables.append(parse_table(suffix_automaton(seq.tolist())))
        bits.append(np.log2(max(2, len(seq))))
    return {"langs": langs, "classes": table, "tables": tables, "bits": np.array(bits)}


def predict(model: dict, texts: pa.Array, segment: int = 512) -> tuple[list[str], list[float]]:
    texts = pc.fill_null(texts, "")
    classes, places = letter_classes(texts, model["classes"])
    lengths = np.diff(places)
    letters = np.concatenate(([0], np.cumsum((classes > 0) & (classes < 27))))[places]
    known = np.diff(letters) > 0
    for i in np.flatnonzero(~known & (lengths > 0)):
        known[i] = any(c.isalpha() for c in texts[int(i)].as_py())
    if not model["langs"]:
        return ["und"] * len(texts), [0.0] * len(texts)
    cost = phrases(classes, places, model["tables"], segment) * model["bits"] / np.maximum(lengths, 1)[:, None]
    best = cost.argmin(1)
    ranked = np.sort(cost, 1)
    second = ranked[:, min(1, ranked.shape[1] - 1)]
    score = second / np.maximum(ranked[:, 0] + second, 1e-12)
    return ([model["langs"][b] if k else "und" for b, k in zip(best, known, strict=True)],
            np.where(known, np.clip(score, 0.0, 1.0), 0.0).tolist())


def identify(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, lang_pred and score of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        return lambda texts: [pa.array(c) for c in _typed(predict(shared.value, texts))]

    return map_text(docs, [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())], make)


def _typed(found):
    return pa.array(found[0], pa.string()), pa.array(found[1], pa.float64())


@query("op1_language_id")
def op1_language_id(spark, sf_dir):
    docs = documents(spark, sf_dir)
    left = remainder("doc_id", 5)
    model = fit(docs.filter(left != 0))
    found = identify(docs, model)
    return found.select("doc_id", F.coalesce(left == 0, F.lit(True)).alias("held_out"), "lang_pred", "score")
