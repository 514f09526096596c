"""The registered queries on sf 0.001 and on small fixtures, against SQL or
plain Python, or by held-out accuracy."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as entry
import corpus_pipeline
from spindle.llm import common, decontaminate, near_dup, packing, secrets, substring_dedup
from spindle.llm.queries import ORACLE, QUERIES
from spindle.plans.verify import compare, duck
from tests.conftest import SF_MID, SF_SMALL
from tests.llm import plain
from tests.llm.conftest import sentence


@pytest.fixture(scope="module")
def texts():
    return dict(duck(SF_SMALL).sql("SELECT doc_id, text FROM documents").fetchall())


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, duck_small, name):
    result = compare(QUERIES[name](spark, SF_SMALL), duck_small, ORACLE[name])
    assert result["ok"], result


def held_out(spark, name, label):
    rows = QUERIES[name](spark, SF_MID).collect()
    known = dict(duck(SF_MID).sql(label).fetchall())
    return [(r, known[r.doc_id]) for r in rows if r.held_out and known.get(r.doc_id) is not None], rows


def test_language_id_held_out(spark):
    pairs, rows = held_out(spark, "op1_language_id", "SELECT doc_id, lang FROM documents")
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert sum(r.lang_pred == y for r, y in pairs) >= 0.98 * len(pairs)


@pytest.mark.parametrize(("name", "label", "parts", "mine"), [("op4_quality_classifier", "quality", 3, 1), ("op8_toxicity", "toxic", 5, 0)])
def test_classifiers_held_out(spark, name, label, parts, mine):
    pairs, rows = held_out(spark, name, f"SELECT doc_id, {label} FROM labels")
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % parts == mine) and r.predicted == int(r.score >= 0.5) for r in rows)
    common = max(sum(y == k for _, y in pairs) for k in (0, 1))
    assert sum(r.predicted == y for r, y in pairs) >= max(0.93 * len(pairs), common)


def test_secret_scan(spark, texts):
    for r in QUERIES["op2_secret_scan"](spark, SF_SMALL).collect():
        base = plain.base_secrets(texts[r.doc_id])
        named = [f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in base]
        assert r.base_sha256 == hashlib.sha256(",".join(named).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for _, x, _ in base) for k in range(3))
        assert set(named) <= set(r.spans.split(","))


def check_packing(rows, texts, size=2048):
    tokens = pytest.importorskip("tokenizers").Tokenizer.from_file(pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json"))
    at = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert max(at.values()) <= size
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == set(texts)
    for doc, text in texts.items():
        ids = [*tokens.encode(text or "", add_special_tokens=False).ids, 0]
        cuts = packing.cut_points(len(ids), size)
        mine = sorted(pieces[doc], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.start + r.length) for r in mine] == [(k, a, b) for k, (a, b) in enumerate(cuts)]
        assert [r.ids_crc32 for r in mine] == [zlib.crc32(np.array(ids[a:b], "<u4").tobytes()) for a, b in cuts]
    return len(at)


def test_packing(spark, texts):
    rows = QUERIES["op5_best_fit_packing"](spark, SF_SMALL).collect()
    total = sum(r.length for r in rows)
    assert check_packing(rows, texts) <= 1.03 * total / 2048 + 1


def near_copies(rng):
    """Groups of near and exact copies, chains, and a hot group."""
    rows, doc = [], 0
    for group in range(12):
        base = sentence(rng, rng.randint(3, 120)).split()
        for _ in range(120 if group == 0 else rng.randint(1, 8)):
            words = base[:]
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                words[rng.randrange(len(words))] = f"w{rng.randint(0, 99)}"
            if rng.random() < 0.3:
                base = words  # drift: links that only chains give
            rows.append((doc * 13 % 1009, " ".join(words)))
            doc += 1
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_lose_no_link(spark, seed):
    rows = near_copies(random.Random(seed))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r[0]: tuple(r)[1:] for r in near_dup.near_duplicates(docs).collect()}
    assert got == plain.near_duplicates(rows)


def test_a_hot_bucket_is_not_compared_pair_by_pair(spark, monkeypatch):
    rng = random.Random(5)
    base = [f"b{k}" for k in range(80)]
    rows = []
    for doc in range(160):  # half of them linked with the base, half of them too far from each other
        words = list(base)
        for k in rng.sample(range(80), 1 if doc % 2 else 4):
            words[k] = f"w{doc}x{k}"
        rows.append((doc, " ".join(words)))
    compared = []
    verify = near_dup.verify

    def counted(pairs, *args):
        compared.append(pairs.count())
        return verify(pairs, *args)

    monkeypatch.setattr(near_dup, "verify", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r[0]: tuple(r)[1:] for r in near_dup.near_duplicates(docs).collect()} == plain.near_duplicates(rows)
    assert len(compared) == 3  # two stars, and what the prefixes leave; there are 12,720 pairs
    assert sum(compared) < 12_720 / 4 and compared[-1] < len(rows)


def test_stars_go_on_while_they_link(spark, monkeypatch):
    """A class that stays out of a large group meets all of it at the
    prefixes, so that stars come first until one links nothing."""
    rng = random.Random(6)
    rows = []
    for doc in range(300):
        words = [f"b{k}" for k in range(100)]
        for k in rng.sample(range(100), 3):
            words[k] = f"w{doc}x{k}"
        rows.append((doc, " ".join(words)))
    stars, left = [], []
    fresh_star, candidates = near_dup.fresh_star, near_dup.candidates

    def star(spots, turn, *args):
        stars.append(turn)
        return fresh_star(spots, turn, *args)

    def meet(spots, *args):
        left.append(spots.select("label").distinct().count())
        return candidates(spots, *args)

    monkeypatch.setattr(near_dup, "fresh_star", star)
    monkeypatch.setattr(near_dup, "candidates", meet)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r[0]: tuple(r)[1:] for r in near_dup.near_duplicates(docs).collect()} == plain.near_duplicates(rows)
    assert 2 <= len(stars) <= near_dup.ROUNDS and len(left) == 1


def test_all_stars_are_checked_in_one_pass(spark, monkeypatch):
    """Each pass costs some twenty jobs, so that a large group whose stars
    link a few classes each takes one, not one a star."""
    rng = random.Random(6)
    rows = []
    for doc in range(300):
        words = [f"b{k}" for k in range(100)]
        for k in rng.sample(range(100), 3):
            words[k] = f"w{doc}x{k}"
        rows.append((doc, " ".join(words)))
    passes = []
    verify = near_dup.verify

    def counted(pairs, *args):
        passes.append(pairs)
        return verify(pairs, *args)

    monkeypatch.setattr(near_dup, "verify", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r[0]: tuple(r)[1:] for r in near_dup.near_duplicates(docs).collect()} == plain.near_duplicates(rows)
    assert len(passes) == 3  # the smallest class of each bucket, the other centres, what the prefixes leave


def test_shuffled_sets_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BROADCAST_IDS", 0)
    rows = near_copies(random.Random(3))[:150]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r[0]: tuple(r)[1:] for r in near_dup.near_duplicates(docs).collect()} == plain.near_duplicates(rows)
    assert near_dup.drop_near_duplicates(docs).count() == sum(k for _, _, k in plain.near_duplicates(rows).values())


def test_dropping_near_copies_sends_no_text_to_python(spark):
    """Ids are looked up by their hashes; whole rows in Arrow batches took an
    executor of the pipeline over its memory."""
    rows = near_copies(random.Random(3))[:60]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = near_dup.drop_near_duplicates(docs)
    plan = left._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" in plan and "MapInArrow" not in plan
    assert {r.doc_id for r in left.collect()} == {k for k, v in plain.near_duplicates(rows).items() if v[-1]}


def test_texts_come_in_batches_of_bounded_rows(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    docs = spark.range(2 * common.BATCH_ROWS + 5, numPartitions=1).select(F.col("id").alias("doc_id"), F.lit("a text").alias("text"))
    try:
        for rows, most in ((10_000, common.BATCH_ROWS), (0, common.BATCH_ROWS), (300, 300)):
            spark.conf.set(key, rows)
            sizes = common.map_text(docs, [T.StructField("n", T.LongType())], lambda: lambda texts: [pa.array([len(texts)] * len(texts))])
            assert {"n": most, "rows": docs.count()} == sizes.agg(F.max("n").alias("n"), F.count("*").alias("rows")).first().asDict()
            spark.conf.set(key, rows)
            assert common.filter_text(docs, lambda: lambda texts: [len(texts) <= most] * len(texts)).count() == docs.count()
    finally:
        spark.conf.set(key, before)


def test_components_of_long_chains(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(200, k) for k in range(201, 260)] + [(260, 259)]
    edges = [e if rng.random() < 0.5 else e[::-1] for e in edges]
    df = spark.createDataFrame(edges, "a long, b long").repartition(6)
    assert {r[0]: r[1] for r in near_dup.components(df).collect()} == {i: 0 if i < 100 else 200 for e in edges for i in e}


@pytest.mark.parametrize("nodes", [3, 20])
def test_union_find_of_few_nodes_at_once(spark, monkeypatch, nodes):
    """A task that knows as many nodes as it may hold passes them on and forgets them."""
    monkeypatch.setattr(near_dup, "FOREST_NODES", nodes)
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(50, 50)]
    random.Random(8).shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long").repartition(3)
    assert {r[0]: r[1] for r in near_dup.components(df).collect()} == {i: 0 if i < 50 else 100 for e in edges[:] if e != (50, 50) for i in e}
    assert near_dup.components(df.limit(0)).collect() == []


def test_items_in_several_parts(spark, texts):
    docs = spark.createDataFrame(list(texts.items())[:80], "doc_id long, text string")
    items = [(k, " ".join(t.split()[3:25])) for k, t in texts.items() if k % 9 == 0]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(plain.contamination(list(texts.items())[:80], items))
    for size in (10_000, 600):
        got = sorted(tuple(r) for r in decontaminate.contamination(docs, bench, max_windows=size).collect())
        assert got == want
        clean = decontaminate.remove_documents(docs, bench, max_windows=size)
        assert {r.doc_id for r in clean.collect()} == {r[0] for r in want if not r[-1]}


def substrings(rng):
    base = [sentence(rng, rng.randint(5, 150)) for _ in range(12)]
    rows = []
    for i in range(90):
        b, kind = rng.choice(base), rng.random()
        if kind < 0.2:
            t = b
        elif kind < 0.65:
            k = rng.randint(0, len(b))
            t = sentence(rng, rng.randint(0, 40)) + b[k:k + rng.randint(20, 400)] + sentence(rng, rng.randint(0, 40))
        elif kind < 0.75:
            t = rng.choice(("ab ", "a", "éé")) * rng.randint(1, 150)
        else:
            t = list(b)
            t[rng.randrange(len(t))] = "z"
            t = "".join(t)
        rows.append((i * 7 % 997, t))
    return rows


@pytest.mark.parametrize("options", [{}, {"crowd": 400}, {"bits": 128, "crowd": 300, "block": 2000}, {"width": 30, "gram": 8}])
def test_substrings(spark, options):
    rows = substrings(random.Random(5))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r[0]: tuple(r)[1:] for r in substring_dedup.cut_repeats(docs, **options).collect()}
    assert got == plain.repeats(rows, options.get("width", 100))


def test_filters_let_few_others_through(spark):
    """As full as the second filter of 6 GB of texts, whose 10 million keys let
    13 in 100 others through when each had one of 1 << 26 bits."""
    rng = np.random.default_rng(4)
    least, most = -(1 << 63), (1 << 63) - 1
    inside, others = rng.integers(least, most, 10_000_000 >> 10), rng.integers(least, most, 20_000)
    hashes = spark.createDataFrame([(int(h),) for h in inside], "h long")
    found = common.bit_set(hashes, substring_dedup.FILTER_BITS >> 10, substring_dedup.PROBES)
    assert common.in_set(found, inside, substring_dedup.PROBES).all()
    assert common.in_set(found, others, substring_dedup.PROBES).mean() < 0.02
    one = common.bit_set(hashes, common.FILTER_BITS >> 10)
    assert common.in_set(one, inside).all() and 0.1 < common.in_set(one, others).mean() < 0.2


def test_full_filters_change_no_result(spark):
    rows = substrings(random.Random(6))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r[0]: tuple(r)[1:] for r in substring_dedup.cut_repeats(docs, bits=64).collect()}
    assert got == plain.repeats(rows, 100)


def test_pipeline(spark, texts):
    """Each stage's effect, from the written tables, and the packed rest."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        seen.append(stage(spark, seen[-1], SF_SMALL).checkpoint())
    kept = [{r.doc_id: r.text for r in d.select("doc_id", "text").collect()} for d in seen]
    toxic = QUERIES["op8_toxicity"](spark, SF_SMALL).filter("score >= 0.5").select("doc_id").collect()
    assert set(kept[1]) == set(texts) - {r.doc_id for r in toxic}
    assert set(kept[2]) == {i for i, (_, _, k) in plain.near_duplicates(list(kept[1].items())).items() if k}
    items = duck(SF_SMALL).sql("SELECT item_id, text FROM benchmark").fetchall()
    assert set(kept[3]) == {r[0] for r in plain.contamination(list(kept[2].items()), items) if not r[-1]}
    assert set(kept[4]) == set(kept[3]) and all(not plain.base_secrets(t) for t in kept[4].values())
    assert all(kept[4][i] == t for i, t in kept[3].items() if not plain.base_secrets(t) and not secrets.find_secrets(t))
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    check_packing(rows, kept[4])
