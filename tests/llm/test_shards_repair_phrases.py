"""Hilbert shards, conversation repair and collocations against plain Python,
on the small tables and on messy ones."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from spindle.llm import collocations, common, conversations, hilbert
from spindle.llm.queries import QUERIES
from spindle.plans.verify import compare, duck
from tests.conftest import SF_MID, SF_SMALL
from tests.llm import plain

# --- shards ----------------------------------------------------------------------


@pytest.mark.parametrize(("dims", "bits"), [(1, 4), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbours(dims, bits):
    points = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    index = hilbert.curve_index(points, bits)
    path = points[np.argsort(index)]
    assert sorted(index) == list(range(len(points)))
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def plain_cells(values, cells):
    known = sorted(v for v in values if v is not None)
    return [0 if v is None else cells * sum(w < v for w in known) // len(known) for v in values]


def test_shards_of_all_documents(spark):
    rows = duck(SF_SMALL).sql("SELECT doc_id, lang, source, coalesce(text, '') FROM documents").fetchall()
    size = [len(t.encode()) + 8 for *_, t in rows]
    crc = [zlib.crc32(t.encode()) for *_, t in rows]
    cells = np.array([plain_cells(c, 64) for c in ([r[1] for r in rows], [r[2] for r in rows], size)]).T
    order = sorted(zip(hilbert.curve_index(cells, 6).tolist(), crc, [r[0] for r in rows], size, strict=True))
    n, used, want = len(rows), Counter(), []
    for k, (curve, c, doc, s) in enumerate(order):
        shard = k * 24 // n
        want.append((doc, s, c, "rows", shard, used[shard], None, curve))
        used[shard] += 1
    got = QUERIES["op11_hilbert_sharding"](spark, SF_SMALL).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert max(used.values()) - min(used.values()) <= 1 and len(used) == 24


def test_shards_prune_and_write(spark, tmp_path):
    rows = spark.range(4000).selectExpr("id", "cast(id * 7919 % 4000 as int) AS a", "cast(id * 104729 % 4000 as double) AS b", "1 + id % 5 AS size")
    for law in ("rows", "bytes"):
        cut = hilbert.hilbert_shards(rows, ["a", "b"], 16, law, "size", ["id"]).cache()
        at = sorted((r.shard, r.slot) for r in cut.collect())
        sizes = Counter(s for s, _ in at)
        assert at == [(s, k) for s in sorted(sizes) for k in range(sizes[s])] and len(sizes) == 16
        if law == "rows":
            assert max(sizes.values()) - min(sizes.values()) <= 1
        else:
            weights = [r[0] for r in cut.groupBy("shard").sum("size").select("sum(size)").collect()]
            assert max(abs(w - sum(weights) / 16) for w in weights) <= 5
        boxes = hilbert.shard_bounds(cut, ["a", "b"]).collect()
        # a filter on an eighth of either dimension reads half the shards at most; in stored order it reads all
        assert sum(b.min_a <= 499 for b in boxes) <= 8 and sum(b.min_b <= 499 for b in boxes) <= 8
    hilbert.write_shards(cut, f"{tmp_path}/out", 100)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == 4000 and set(back.columns) == set(cut.columns)
    assert back.selectExpr("input_file_name() AS f", "slot div 100 AS run").groupBy("f").agg({"run": "count"}).count() >= 16


def test_shards_of_messy_rows(spark, messy, nothing):
    named = messy.withColumns({"shard": messy.n_chars, "slot": messy.n_chars})
    for law in ("rows", "bytes"):
        got = hilbert.hilbert_shards(named, ["lang", "score", "doc_id"], 3, law, "n_chars", ["text"]).collect()
        slots = sorted((r.shard, r.slot) for r in got)
        sizes = Counter(s for s, _ in slots)
        assert len(got) == messy.count() and slots == [(s, k) for s in sorted(sizes) for k in range(sizes[s])]
    assert hilbert.hilbert_shards(nothing, ["lang", "doc_id"], 3).collect() == []
    wide = spark.createDataFrame([(float("nan"), None), (1.0, True), (None, False)], "x double, y boolean")
    assert {r.slot for r in hilbert.hilbert_shards(wide, ["x", "y"], 1).collect()} == {0, 1, 2}
    with pytest.raises(TypeError):
        hilbert.hilbert_shards(messy, ["items"])


def test_many_equal_rows_are_split(spark):
    same = spark.range(3000).selectExpr("'x' AS lang", "1L AS size")
    cut = hilbert.hilbert_shards(same, ["lang", "size"], 7, ranges=6)
    assert sorted(r["count"] for r in cut.groupBy("shard").count().collect()) == [428, 428, 428, 429, 429, 429, 429]


# --- conversations ---------------------------------------------------------------

def plain_audit(letters):
    """Least (cost, audit) over all edits, and the roles that it leaves."""
    best = {}

    def go(i, state, inserted):
        key = (i, state, inserted)
        if key in best:
            return best[key]
        found = [(0, "")] if i == len(letters) and state in "0a" else []
        follow = {"0": "u", "s": "u", "u": "a", "a": "u"}[state]
        if inserted < 3:
            c, a = go(i, follow, inserted + 1)
            found.append((c + 5, "I" + a))
        if i < len(letters):
            x = letters[i]
            c, a = go(i + 1, state, 0)
            found.append((c + 2, "D" + a))
            if x != "x":
                late = 5 * x.isupper()
                if x.lower() == follow or (x.lower() == "s" and state == "0"):
                    c, a = go(i + 1, x.lower(), 0)
                    found.append((c + late, "K" + a))
                c, a = go(i + 1, follow, 0)
                found.append((c + late + 1, "R" + a))
        best[key] = min(found, default=(10**9, ""))
        return best[key]

    for i in range(len(letters), -1, -1):
        for state in "0sua":
            go(i, state, 0)
    return go(0, "0", 0)


def test_automaton_gives_the_least_audit():
    words = sorted(("".join(w) for n in range(6) for w in itertools.product("suaoUAx", repeat=n)), key=lambda w: w[::-1])
    shared = conversations.SuffixAutomaton(conversations.END)
    for w in words:
        shared.read(w)
        cost, audit = plain_audit(w)
        mine = shared.audit(conversations.START) if w else ""
        assert shared.cost(conversations.START) == cost
        assert audit.startswith(mine) and set(audit[len(mine):]) <= {"I"}
    assert shared.built == len(words) - 1  # each suffix once


def plain_repair(rows):
    """By conv_id, from (conv_id, turn, role, text) rows, damaged."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = []
        for c, turn, role, text in rows:
            if c == conv:
                show = lambda v: " " if v is None else str(v)
                kind = zlib.crc32(f"{show(c)}:{show(turn)}".encode()) % 20
                role, text = show(role), show(text)
                text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
                mine += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(f"{len(r[1])}:{r[1]}:{r[2]}".encode()).hexdigest()))
        letters, seen, faults = "", set(), Counter()
        for _, role, text in mine:
            shown = text.strip(" \t\n\v\f\r")
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            x = role[:1] if role[:1] in tuple("sua") else "o"
            letters += "x" if fault in ("blank", "duplicate") else x.upper() if fault else x
        cost, audit = plain_audit(letters)
        left, at, state = [], 0, ""
        for edit in audit:
            turn, role, text = mine[at] if at < len(mine) else (None, "", "")
            at += edit != "I"
            if edit != "D":
                left.append((role if edit == "K" else None, "" if edit == "I" else text))
        roles = (["system"] if len(left) % 2 else []) + ["user", "assistant"] * (len(left) // 2)
        body = "\n".join(f"{r or want}:{t}" for (r, t), want in zip(left, roles, strict=True))
        turns = [t for t, *_ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in itertools.pairwise(mine))
        out[conv] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256(body.encode()).hexdigest())
    return out


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_repair_of_all_conversations(spark, sf):
    rows = duck(sf).sql("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op12_conversation_repair"](spark, sf).collect()}
    assert got == plain_repair(rows)


def messy_turns():
    rng = random.Random(11)
    texts = ["Hi.", "what?", "no end", "", "  \n", None, "Same.", "Same. ", "end.\n", "é!", "long " * 20_000]
    roles = ["system", "user", "assistant", "tool", None, "", "sage"]
    rows = [(rng.choice([1, 2, 3, None, 5, 6]), rng.choice([None, *range(9)]), rng.choice(roles), rng.choice(texts)) for _ in range(200)]
    return [*rows, *rows[:20], (7, None, "user", "x.")]


@pytest.mark.parametrize("block", [conversations.BLOCK, 1, 3])
def test_repair_of_messy_rows(spark, block):
    rows = messy_turns()
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, digest string, seq int").repartition(5)
    damaged = conversations.damage(df)
    got = {r[0]: tuple(r)[1:] for r in conversations.audit_conversations(damaged, block).collect()}
    assert got == plain_repair(rows)
    fixed = conversations.repair_conversations(damaged, block).orderBy("conv_id", "position").collect()
    for conv, group in itertools.groupby(fixed, key=lambda r: r.conv_id):
        group = list(group)
        assert [r.position for r in group] == list(range(len(group)))
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in group))
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in group).encode()).hexdigest() == got[conv][-1]


def test_repair_edges(spark):
    df = spark.createDataFrame([(1, 0, "user", "a.")], "conv_id long, turn long, role string, text string")
    assert conversations.audit_conversations(conversations.damage(df.filter("false"))).collect() == []
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    empty = conversations.audit_conversations(conversations.damage(df.selectExpr(f"{dropped}L AS conv_id", "turn", "role", "text"))).collect()
    assert [tuple(r) for r in empty] == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    kept = conversations.audit_conversations(conversations.whole(df)).collect()
    assert [(r.cost, r.audit) for r in kept] == [(2, "D")]


def test_hot_conversation_in_blocks(spark):
    """One conversation with most of the rows, many of them equal."""
    rng = random.Random(5)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Same.", f"t{t}.", f"t{t}", " "])) for t in range(600)]
    rows += [(c, t, "user", "Same.") for c in range(2, 40) for t in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    got = {r[0]: tuple(r)[1:] for r in conversations.audit_conversations(conversations.damage(df), 16).collect()}
    assert got == plain_repair(rows)


# --- collocations ------------------------------------------------------------------

def plain_collocations(docs, least, top, longest=5):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", plain.lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + m])) for m in range(1, longest + 1) for i in range(len(w) - m + 1))
    cand = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    gone = {(lang, p[i:j]) for (lang, p), a in cand.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
            if j - i < len(p) and 100 * a >= 100 * f[lang, p[i:j]]}
    rows = []
    for (lang, p), a in cand.items():
        if (lang, p) not in gone:
            score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            rows.append((lang, -score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    out, rank = [], Counter()
    for lang, s, a, p, left, right in sorted(rows):
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], p.decode(), -a, left, right, n[lang], -s))
    return out


@pytest.mark.parametrize(("least", "top"), [(2, 2000), (5, 40)])
def test_collocations_of_documents(spark, least, top):
    con = duck(SF_SMALL)
    rows = con.sql("SELECT lang, text FROM documents").fetchall()
    got = collocations.collocations(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), least, top)
    assert sorted(map(tuple, got.collect())) == plain_collocations(rows, least, top)


def test_collocations_of_messy_rows(spark, messy, messy_rows, nothing, monkeypatch):
    rows = [(lang, t) for _, t, lang in messy_rows]
    want = plain_collocations(rows, 2, 50)
    assert sorted(map(tuple, collocations.collocations(messy, 2, 50).collect())) == want
    # sets so small that nearly every bit is set, and shards of a few texts, change no result
    monkeypatch.setattr(collocations, "SHARD_BYTES", 200)
    monkeypatch.setattr(common.bit_set, "__defaults__", (128,))
    assert sorted(map(tuple, collocations.collocations(messy, 2, 50, ranges=3).collect())) == want
    assert collocations.collocations(nothing).collect() == []


def test_collocation_sql_on_more_rows(spark):
    found = compare(QUERIES["op13_phrase_collocations"](spark, SF_MID), duck(SF_MID), collocations.COLLOCATIONS)
    assert found["ok"], found


def test_transducer_round_trip():
    rng = random.Random(2)
    rows = sorted({(1, *(rng.randint(0, 6) for _ in range(4))) for _ in range(900)})
    paths = np.array(rows, np.int64)
    counts = np.array([rng.choice([1, 1, 1, 2, 7]) for _ in rows], np.int64)
    words = pa.array([b"lang", *(f"w{k}".encode() for k in range(2, 8))], pa.binary())
    one = collocations.CountTransducer.build(words, paths, counts)
    back = collocations.CountTransducer.from_bytes(one.to_bytes())
    got, weight = back.rows()
    assert (got == paths).all() and (weight == counts).all()
    assert sum(len(layer[1]) for layer in one.layers) < paths.size  # beginnings and ends are shared
    asked = np.array([*rows[:50], (1, 6, 6, 6, 6), (2, 1, 1, 1, 1)], np.int64)
    want = [dict(zip(rows, counts.tolist(), strict=True)).get(tuple(r), -1) for r in asked.tolist()]
    assert one.compose(words, asked).tolist() == want
