"""The methods against plain versions of themselves, without Spark."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from spindle.llm import common, decontaminate, langid, near_dup, packing, quality_model, secrets, substring_dedup, toxicity, url_filter
from spindle.llm.induced_sort import suffix_arrays
from tests.llm import plain


def test_suffix_arrays_by_induction():
    rng = np.random.default_rng(1)
    for _ in range(120):
        n, lanes, letters = (int(rng.integers(1, k)) for k in (60, 6, 5))
        text = rng.integers(1, letters + 1, (n, lanes))
        for b in range(lanes):
            if rng.random() < 0.4:
                text[n - rng.integers(0, n):, b] = 0
            if rng.random() < 0.3:
                text[:, b] = np.tile(text[:rng.integers(1, 4), b], n)[:n]
        got = suffix_arrays(text)
        for b in range(lanes):
            t = text[:, b].tolist()
            assert got[:, b].tolist() == sorted(range(n), key=lambda i, t=t: t[i:])


def slow_superminhash(elements, slots):
    """One element after another, with a real shuffle."""
    low = [float("inf")] * slots
    for e in elements:
        order = list(range(slots))
        for j in range(slots):
            r = int(near_dup.mix(np.array([(int(e) + int(near_dup.GOLDEN) * (j + 1)) % (1 << 64)], np.uint64))[0])
            k = j + (((r & 0xFFFFFFFF) * (slots - j)) >> 32)
            order[j], order[k] = order[k], order[j]
            low[order[j]] = min(low[order[j]], j + (r >> 32) / 4294967296.0)
    return low


def test_superminhash_rounds():
    rng = np.random.default_rng(2)
    sets = [rng.integers(0, 1 << 63, n, np.uint64) for n in (0, 1, 2, 5, 40, 300)]
    got = near_dup.superminhash(sets, 16)
    assert np.isinf(got[0]).all()
    for s, row in zip(sets[1:], got[1:], strict=True):
        assert row.tolist() == slow_superminhash(s, 16)


def test_superminhash_estimates():
    rng = np.random.default_rng(3)
    core = rng.integers(0, 1 << 63, 400, np.uint64)
    a, b = np.append(core, rng.integers(0, 1 << 63, 50, np.uint64)), np.append(core, rng.integers(0, 1 << 63, 50, np.uint64))
    sig = near_dup.superminhash([a, b])
    assert abs((sig[0] == sig[1]).mean() - 0.8) < 0.12


def test_near_dup_hashes_few_bytes_at_once(monkeypatch):
    """A Python worker of near-dedup holds 30 MB at most while it hashes, tables of powers included."""
    monkeypatch.setattr(near_dup, "_POWERS", [])
    rng = random.Random(3)
    batch = pa.record_batch({"text": [" ".join(rng.choice("abcdefgh") * rng.randint(1, 9) for _ in range(400)) for _ in range(800)]})
    tracemalloc.start()
    try:
        for part in common.slices(batch, "text", near_dup.STEP_BYTES):
            near_dup.band_keys(near_dup.superminhash(near_dup.shingle_sets(part.column(0))))
        assert tracemalloc.get_traced_memory()[1] < 30e6
    finally:
        tracemalloc.stop()


def test_word_hashes_follow_the_word_rule():
    texts = ["A b\tc\x0bd", "a B", "", "é É a", None, "a\u00a0b c"]
    hashes, places = near_dup.word_hashes(pa.array(texts, pa.string()))
    words = [plain.SPACED.findall(plain.lower(t)) for t in texts]
    assert np.diff(places).tolist() == list(map(len, words))
    flat = [w for ws in words for w in ws]
    assert [hashes[i] == hashes[j] for i in range(len(flat)) for j in range(i)] == [flat[i] == flat[j] for i in range(len(flat)) for j in range(i)]


def test_phrases_match_greedy_parsing():
    rng = random.Random(4)
    sample = [rng.choice([0, 1, 2, 3]) for _ in range(60)]
    table = langid.parse_table(langid.suffix_automaton(sample))
    texts = [[rng.choice([0, 1, 2, 3, 4]) for _ in range(rng.randint(0, 40))] for _ in range(30)]
    texts += [[1, 2] * 50, [3] * 90, sample * 3, [], [4] * 33]
    places = np.cumsum([0, *map(len, texts)])
    got = langid.phrases(np.array(sum(texts, []), np.uint8), places, [table], segment=16)
    joined = "".join(map(str, sample))

    def greedy(t):
        n = at = 0
        while at < len(t):
            end = at
            while end < len(t) and t[at:end + 1] in joined:
                end += 1
            at, n = max(end, at + 1), n + 1
        return n

    for t, n in zip(texts, got[:, 0], strict=True):
        s = "".join(map(str, t))
        assert n == greedy(s)


def test_language_tables_have_a_bound(spark):
    rows = [(k, f"{chr(97 + k % 20)}ab{k} " * 400, f"l{k % 20}") for k in range(100)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), all_chars=20_000)
    assert len(model["langs"]) == 20 and sum(t.nbytes for t in model["tables"]) <= 2 * 20_000 * 64 * 4
    assert langid.predict(model, pa.array([rows[3][1], rows[17][1]]))[0] == ["l3", "l17"]


def test_composed_weights_are_the_sum_of_the_parts():
    parts = [toxicity.insult_transducer(), toxicity.target_transducer(), toxicity.threat_transducer(), toxicity.negation_transducer(), toxicity.report_transducer()]
    to, weight = toxicity.grammar()
    rng = random.Random(5)
    for _ in range(200):
        tags = [rng.randrange(toxicity.TAGS) for _ in range(30)]
        state, total, states = 0, 0.0, [0] * len(parts)
        for tag in tags:
            total += weight[state][tag]
            state = to[state][tag]
        expected = 0.0
        for k, part in enumerate(parts):
            for tag in tags:
                states[k], w = part.get((states[k], tag), (states[k], 0.0))
                expected += w
        assert total == pytest.approx(expected)


def score(text, model):
    tagger = toxicity.Tagger(model["words"], model["stems"])
    return float(toxicity.features(pa.array([text]), tagger, toxicity.grammar())[0] @ toxicity.PRIOR)


def test_clauses_not_words():
    words = {w: tag for tag, seeds in toxicity.SEEDS.items() for w in seeds}
    model = {"words": words, "stems": {"scoundr": toxicity.STRONG}}
    plainly, targeted = score("The idiot went home", model), score("You are an idiot", model)
    assert targeted > plainly > score("It is not an idiot", model)
    assert score("He said it was an idiot thing", model) < plainly
    assert score("I will kill you", model) > score("I will kill time", model) == score("Nothing here now", model)
    assert score("a scoundrel", model) > score("a scoundr", model)


def test_guess_costs():
    cheap = ["password1", "qwertyuiop", "aaaaaaaaaaaaaaaa", "monkey1999", "abcabcabcabcabc", "2024-05-17", "P@ssword"]
    dear = ["04dbebab91ab85687d33eeaaf9", "xK9#mQ2$vL7!", "Zq8-Rt3_Wp6.Yn1"]
    assert max(map(secrets.guess_bits, cheap)) < secrets.MIN_BITS <= min(map(secrets.guess_bits, dear))
    long = "k3" + "Jx9_" * 5000 + "".join(random.Random(1).choices("abcXYZ019", k=5000))
    assert secrets.guess_bits(long, 40.0) >= 40.0
    assert secrets.guess_bits("") == 0.0


def test_long_repeats_and_walks_are_one_span():
    for unit, least in (("*", 5.0), ("a", 4.7), ("ab", 9.4), ("=-", 10.0)):
        assert secrets.guess_bits(unit * 500) <= least + 9.1, unit
        assert all(kind != 3 for _, kind, _, _ in secrets.find_secrets("pwd: " + unit * 500)), unit
    assert secrets.guess_bits("qwertyuiop" + "oiuytrewqwertyuiop" * 20) < secrets.MIN_BITS
    assert secrets.guess_bits("*" * 100_000, 40.0) < 23


def test_base_secrets_match_the_patterns():
    rng = random.Random(6)
    parts = ['password', 'PassWD', 'secret', 'token', 'api_key', 'apikey', ' ', ' : ', '=', '"', "'", 'abc', 'abcdef12', 'AKIA', 'ABCDEFGH12345678', 'a1b2' * 7, 'é', 'ſecret', '\n', 'x' * 7]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(1, 14)))
        got = [(a, k, b) for a, k, b, _ in secrets.find_secrets(text) if k < 3]
        assert got == plain.base_secrets(text), text


def test_trie_against_a_scan_of_the_rules():
    rng = random.Random(7)
    hosts, paths = ["com", "a.com", "b.a.com", "net", "x.net"], ["/", "/en/", "/en", "/en/x", "/e", ""]
    rules = [url_filter.Rule(rng.choice(("allow", "block")), h, p) for h in hosts for p in paths if rng.random() < 0.5]
    trie = url_filter.build_trie(rules)
    for _ in range(800):
        host = ".".join(rng.choices(["a", "b", "x", "q"], k=rng.randint(0, 3)) + [rng.choice(["com", "net", "org"])])
        path = rng.choice(["", "/", "/en", "/en/", "/en/x/y", "/english", "/de/en/"])
        fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: (len(r.host), len(r.path)), default=None)
        found = url_filter.find_rule(trie, host, path)
        assert (found and found[1]) == (best and (best.name, best.action))


def test_packing_plan_holds_every_piece():
    rng = np.random.default_rng(8)
    for size, n in ((64, 5), (64, 400), (256, 3000), (2048, 30)):
        lengths, counts = np.unique(rng.integers(1, size + 1, n), return_counts=True)
        histogram = dict(zip(lengths.tolist(), counts.tolist(), strict=True))
        used = packing.plan(histogram, size)
        held = {}
        for config, copies in used:
            assert sum(config) <= size and copies > 0
            for s in config:
                held[s] = held.get(s, 0) + copies
        assert held == histogram
        best = -(-int((lengths * counts).sum()) // size)
        big = int(counts[lengths > size // 2].sum())
        assert sum(c for _, c in used) <= max(best, big) * 1.12 + 2
    assert packing.plan({}, 8) == []


def test_knapsack_is_optimal():
    sizes, price = np.array([3, 5, 7]), np.array([0.3, 0.6, 0.75])
    value, _ = packing.knapsack(sizes, price, 20)
    best = max(0.3 * a + 0.6 * b + 0.75 * c for a in range(7) for b in range(5) for c in range(3) if 3 * a + 5 * b + 7 * c <= 20)
    assert value[20] == pytest.approx(best)


def test_token_ids_equal_the_tokenizers_library():
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    encoder = packing.Encoder(*packing.vocabulary())
    for text in ["", " ", "a  b", "\n a b'll we've 's '' '", "é à b\u3000d", "x<|endoftext|>\ny", "1 2 ３ 4a b_ c", "The thon.\nEr\r\n\r\n!"]:
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_cut_points():
    assert packing.cut_points(5, 8) == [(0, 5)] and packing.cut_points(8, 8) == [(0, 8)]
    assert packing.cut_points(17, 8) == [(0, 1), (1, 9), (9, 17)] and packing.cut_points(16, 8) == [(0, 8), (8, 16)]


def test_trees_go_down_like_one_row_at_a_time():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(900, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > 0)).astype(float)
    model = quality_model.fit_trees(x, y, trees=20, depth=3)
    got = quality_model.predict(model, x[:50])
    for row, p in zip(x[:50], got, strict=True):
        s = model["base"]
        for f, limit, leaf in zip(model["feature"], model["limit"], model["leaf"], strict=True):
            at = 0
            for _ in range(3):
                at = 2 * at + 1 + int(row[f[at]] > limit[at])
            s += leaf[at - 7]
        assert p == pytest.approx(1 / (1 + np.exp(-s)))
    assert ((quality_model.predict(model, x) >= 0.5) == y).mean() > 0.97


def test_spans_are_cut_out_of_the_text():
    marks = decontaminate.Windows([("i", "b c")], 10).hits("A, b c! d b-C")[0]
    assert marks.tolist() == [False, True, True, False, True, True]
    assert decontaminate._without("A, b c! d b-C", marks.tobytes()) == "A, ! d "


def test_merge_of_spans():
    got = substring_dedup.merge(np.array([[5, 9], [0, 3], [3, 4], [8, 12], [20, 21]]))
    assert got.tolist() == [[0, 4], [5, 12], [20, 21]]


def test_periodic_text_is_few_regions(spark):
    import pyarrow as pa
    for text in ("a" * 100_000, "ab" * 50_000, ("=" * 70 + "\n") * 1500):
        assert len(substring_dedup.Regions(pa.array([text])).anchor) < 3000
    docs = [(1, "x" * 3000), (2, "start " + "x" * 500 + " end" + "ab" * 400), (3, "ab" * 300 + "y" * 99), (4, ("-" * 30 + "\n") * 60), (5, "tail " + ("-" * 30 + "\n") * 5)]
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    for options in ({}, {"crowd": 300, "block": 3000}):
        assert {r[0]: tuple(r)[1:] for r in substring_dedup.cut_repeats(rows, **options).collect()} == plain.repeats(docs, 100)


def test_equal_windows_share_a_key():
    """Of two texts with a common string of ``width`` bytes, both have a region with a common key."""
    import pyarrow as pa
    rng = random.Random(9)
    for alphabet in ("ab", "abcdefgh", "a"):
        for _ in range(60):
            common = "".join(rng.choice(alphabet) for _ in range(100))
            texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 120))) + common + "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 120))) for _ in range(2)]
            a, b = (set(substring_dedup.Regions(pa.array([t])).keys.tolist()) for t in texts)
            assert a & b


def plain_guess_bits(value):
    """Least cost over all segmentations, each segment tried as everything it can be."""
    import math
    low, n = value.lower(), len(value)

    def segment(i, e):
        text, found = low[i:e], []
        if e - i >= 3:
            for form, extra in ((text, 0.0), (text.translate(secrets.LEET), 2.0)):
                if form in secrets.RANK:
                    found.append(math.log2(secrets.RANK[form] + 1) + extra + (0.0 if value[i:e].islower() else 1.0))
            if all(p in secrets.NEXT for p in zip(text, text[1:], strict=False)):
                found.append(math.log2(len(secrets.WALKS) * 10) + math.log2(e - i))
        for width in range(1, 5):
            if (e - i) % width == 0 and e - i >= max(3, 2 * width) and value[i:e] == value[i:i + width] * ((e - i) // width):
                found.append(sum(secrets.char_bits(" ", x) for x in value[i:i + width]) + math.log2((e - i) / width))
        if (m := secrets.DATE.match(value, i)) and m.end() == e:
            found.append(math.log2(200) if e - i == 4 else math.log2(200 * 365) + 2)
        if e - i == 4 and text[:2] in ("19", "20") and secrets.DATE.match(value, i):
            found.append(math.log2(200))
        return min(found, default=math.inf)

    best = [0.0] + [math.inf] * n
    for e in range(1, n + 1):
        best[e] = min([best[e - 1] + secrets.char_bits(value[e - 2] if e > 1 else " ", value[e - 1]),
                       *(best[i] + (1.0 if i else 0.0) + segment(i, e) for i in range(e))])
    return best[n]


def test_guess_cost_is_least_over_all_segmentations():
    rng = random.Random(7)
    bits = ["password", "Summer", "2023", "1999-12-31", "qwerty", "aaaa", "abab", "x7", "k", "Z", "$", "12345", "dr4g0n", "é", "31.12.2020", "zxc"]
    for _ in range(400):
        value = "".join(rng.choice(bits) for _ in range(rng.randint(1, 6)))
        assert abs(secrets.guess_bits(value) - plain_guess_bits(value)) < 1e-9, value


def test_short_random_values_are_secrets_and_words_are_not():
    for text in ("pwd: x7k2m9q4", "pwd: aX9$kQ2!", "password: aX9$kQ2!", "pwd: kqzvwxjpbnm",
                 "access_key_for_the_production_billing_system_eu = Zk39dLqPz81mXcVbn20a", "secret" + " " * 40 + "=" + "\t" * 30 + "Zk39dLqPz81mXcVbn20a"):
        assert any(k == 3 for _, k, _, _ in secrets.find_secrets(text)), text
    for text in ("password: Summer2023!", "pwd: changeme123", "token: qwerty12345", "secret is invalidated", "password: password1", "pwd: " + "*" * 160, "token is placeholder_value"):
        assert not any(k == 3 for _, k, _, _ in secrets.find_secrets(text)), text
    import time
    start = time.time()
    secrets.find_secrets("token" * 60_000 + " " * 200_000 + "pwd" * 50_000)
    assert time.time() - start < 5


def test_near_duplicates_of_texts_that_share_an_id(spark):
    words = [f"w{k}" for k in range(200)]
    a, b = " ".join(words[:90]), " ".join(words[100:190])
    near_a, near_b = a.replace("w5 ", "zz "), b.replace("w105 ", "zz ")
    rows = [(1, a), (1, b), (2, near_b), (3, near_a), (1, a), (4, "alone in the world of texts")]
    for order in (rows, rows[::-1], rows[2:] + rows[:2]):
        docs = spark.createDataFrame(order, "doc_id long, text string").repartition(3)
        got = {(r.doc_id, r.component_id, r.kept) for r in near_dup.near_duplicates(docs).collect()}
        assert got == {(1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True)}
        assert sorted(map(tuple, near_dup.drop_near_duplicates(docs).collect())) == sorted([(1, a), (1, b), (4, "alone in the world of texts")])


def test_rare_script_is_judged_by_its_own_reference(spark):
    from spindle.llm import quality_rules
    rng = random.Random(4)
    latin, greek = "the of and in to water house".split(), "και το του της με νερο σπιτι".split()
    text = lambda words: ". ".join(" ".join(rng.choice(words) + rng.choice("abcdefgh" if words is latin else "αβγδεζηθ") for _ in range(9)) for _ in range(12)) + "."
    rows = [(k, text(latin), "en") for k in range(2000)] + [(5000 + k, text(greek), "el") for k in range(3)] + [(6000, text(greek), "rare"), (6001, text(latin), None)]
    got = {r.doc_id: r for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[5000 + k].kept for k in range(3)) and got[6000].kept and got[6001].kept
    odd = quality_rules.judge(spark.createDataFrame([*rows, (7000, text(greek), "en")], "doc_id long, text string, lang string"))
    assert not odd.filter("doc_id = 7000").first().kept


def test_packing_plan_is_near_its_bound():
    rng = np.random.default_rng(1)
    for lengths in ([350, 400, 683, 690, 700, 1025, 1030], [650, 700, 1300], [1100], [3, 5, 2000]):
        kinds, n = np.unique(rng.choice(lengths, 30_000), return_counts=True)
        histogram = dict(zip(kinds.tolist(), n.tolist(), strict=True))
        used, bound = packing.bounded_plan(histogram, 2048)
        left = np.zeros(2049, np.int64)
        left[kinds] = n
        plain = sum(k for _, k in packing.best_fit(left, 2048))
        assert bound <= sum(k for _, k in used) <= min(plain, 1.005 * bound + 1)
        held = {}
        for config, copies in used:
            assert sum(config) <= 2048
            for s in config:
                held[s] = held.get(s, 0) + copies
        assert held == histogram


def test_packing_bound_is_below_every_plan():
    # exact optimum of small cases: fewest sequences over all ways to fill them
    from functools import lru_cache

    rng = np.random.default_rng(2)
    for _ in range(20):
        lengths = tuple(sorted(rng.integers(2, 10, 7).tolist(), reverse=True))

        @lru_cache(None)
        def fewest(i, rooms):
            if i == len(lengths):
                return len(rooms)
            options = [fewest(i + 1, tuple(sorted((*rooms, 12 - lengths[i]))))]
            options += [fewest(i + 1, tuple(sorted((*rooms[:j], r - lengths[i], *rooms[j + 1:])))) for j, r in enumerate(rooms) if r >= lengths[i]]
            return min(options)

        kinds, n = np.unique(lengths, return_counts=True)
        used, bound = packing.bounded_plan(dict(zip(kinds.tolist(), n.tolist(), strict=True)), 12)
        assert bound <= fewest(0, ()) <= sum(k for _, k in used) <= fewest(0, ()) + 1


def test_training_text_takes_windows_of_all_different_texts():
    head = "same header " * 200
    texts = [head + chr(97 + i) * 5000 for i in range(20)] + ["short one", "short one"]
    got = langid.training_text(texts, 12_000)
    assert len(got) <= 12_000 and got.count("short one") == 1
    assert all(chr(97 + i) * 100 in got for i in range(20))
    assert langid.training_text(texts, 10**6).count("short one") == 1
    assert langid.excerpt("abc", 0) == "" and langid.training_text([], 10) == ""


def test_lone_regions_are_not_sorted():
    """What a filter let through by chance is alone in its shard."""
    shard = np.array([7, 5, 5, 9, 3, 8])
    places, crowded = np.array([1, 1, 1, 2, 1, 1]), np.array([False, False, False, False, True, False])
    assert substring_dedup.may_repeat(shard, places, crowded).tolist() == [False, True, True, True, True, False]
    none = np.zeros(0, np.int64)
    assert substring_dedup.may_repeat(none, none, none.astype(bool)).tolist() == []
