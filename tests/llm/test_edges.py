"""Every operator and stage over messy and empty tables with extra columns."""

import math
import zlib

import pytest

import corpus_pipeline
from spindle.llm import decontaminate, langid, near_dup, packing, quality_model, quality_rules, secrets, substring_dedup, toxicity, url_filter
from tests.llm import plain


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_language_id(messy, nothing):
    model = langid.fit(messy)
    found = rows_of(langid.identify(messy, model), "doc_id", "lang_pred", "score")
    assert len(found) == messy.count()
    assert {r[1:] for r in found if r[0] in (1, 2, 3)} == {("und", 0.0)} and all(0 <= r[2] <= 1 for r in found)
    assert {r[1] for r in found} <= {"und", "en", "fr", "de", "es"}
    assert langid.identify(nothing, model).collect() == []
    assert {r[1] for r in rows_of(langid.identify(messy, langid.fit(nothing)), "doc_id", "lang_pred")} == {"und"}


def test_secrets(messy, messy_rows, nothing):
    got = rows_of(secrets.scan_secrets(messy), "doc_id", "n_assign", "n_hex", "spans")
    assert (10, 1, 1, "assign:2:53,hex:11:51,guess:11:51") in got or any(r[0] == 10 and r[1:3] == (1, 1) for r in got)
    assert sum(r[1] for r in got) == 1 and len(got) == len(messy_rows)
    assert secrets.scan_secrets(nothing).collect() == []
    hidden = secrets.redact(messy)
    assert hidden.columns == messy.columns and hidden.count() == messy.count()
    assert [r.text for r in hidden.filter("doc_id = 10").collect()] == ['a token = "[SECRET]" é']


def test_decontamination(messy, messy_rows, nothing, bench_items, benchmark_rows):
    got = rows_of(decontaminate.contamination(messy, bench_items), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    docs = [(i, t) for i, t, _ in messy_rows]
    assert got == sorted(plain.contamination(docs, benchmark_rows), key=repr)
    assert decontaminate.contamination(nothing, bench_items).collect() == []
    assert decontaminate.contamination(messy, bench_items.filter("false")).filter("n_hit > 0").isEmpty()
    for clean in (decontaminate.remove_documents(messy, bench_items), decontaminate.remove_spans(messy, bench_items)):
        assert clean.columns == messy.columns and clean.count() == messy.count()


def test_quality_classifier(messy, nothing, label_rows):
    for docs, labels in ((messy, label_rows), (nothing, label_rows), (messy, label_rows.filter("false")), (messy, label_rows.filter("quality = 1"))):
        model = quality_model.fit(docs, labels, trees=3)
        got = quality_model.score_quality(messy, model).collect()
        assert len(got) == messy.count() and all(0 <= r.score <= 1 and not math.isnan(r.score) for r in got)
    assert quality_model.score_quality(nothing, model).collect() == []


def test_toxicity(messy, nothing, label_rows):
    for docs, labels in ((messy, label_rows), (nothing, label_rows), (messy, label_rows.filter("false"))):
        model = toxicity.fit(docs, labels)
        got = rows_of(toxicity.score_toxicity(messy, model), "doc_id", "score")
        assert len(got) == messy.count() and all(0 <= s <= 1 for _, s in got)
    assert dict(got)[11] == max(s for _, s in got) > 0.5
    left = toxicity.remove_toxic(messy, model)
    assert left.columns == messy.columns and left.filter("doc_id = 11").isEmpty() and left.count() == messy.count() - 1
    assert toxicity.score_toxicity(nothing, model).collect() == []


def test_packing(messy, messy_rows, nothing):
    got = packing.pack_documents(messy).collect()
    assert {(r.doc_id, r.start, r.length) for r in got} >= {(1, 0, 1), (2, 0, 1)}
    assert len([r for r in got if r.doc_id == 5]) == 2
    assert packing.pack_documents(nothing).collect() == []
    # round trip: the pieces are those of all texts, and sequences have no gaps
    encoder = packing.Encoder(*packing.vocabulary())
    want = []
    for doc, text, _ in messy_rows:
        ids = encoder.ids(text) + b"\0" * 4
        want += [(doc, k, a, b - a, zlib.crc32(ids[4 * a:4 * b])) for k, (a, b) in enumerate(packing.cut_points(len(ids) // 4, packing.SIZE))]
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got], key=repr) == sorted(want, key=repr)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= packing.SIZE


def test_url_filter(spark):
    urls = [(1, None), (2, ""), (3, "no scheme"), (4, "HTTP://WWW.Example.COM/en/x?q#f"), (4, "http://example.com"), (None, "x://net/es/"), (6, "http://a/" + "b/" * 50_000)]
    pages = spark.createDataFrame([(i, u, "h", "r", "v") for i, u in urls], "page_id long, url string, html string, host string, rule string")
    got = {(r.page_id, r.host, r.rule, r.verdict) for r in url_filter.judge_urls(pages).collect()}
    assert got == {(1, "", None, "block"), (2, "", None, "block"), (3, "", None, "block"), (4, "www.example.com", "www.example.com/en/", "allow"),
                   (4, "example.com", None, "allow"), (None, "net", "net/es/", "block"), (6, "a", None, "allow")}
    assert url_filter.judge_urls(pages.filter("false")).collect() == []


def test_near_duplicates(messy, messy_rows, nothing):
    got = rows_of(near_dup.near_duplicates(messy), "doc_id", "n_shingles", "component_id", "kept")
    want = plain.near_duplicates([(i, t) for i, t, _ in messy_rows if i is not None])
    assert got == sorted([(i, *want[i]) for i, _, _ in messy_rows if i is not None] + [(None, len(plain.shingles(t)), None, True) for i, t, _ in messy_rows if i is None], key=repr)
    assert near_dup.near_duplicates(nothing).collect() == []
    left = near_dup.drop_near_duplicates(messy)
    assert left.columns == messy.columns and rows_of(left, "doc_id") == sorted([(i,) for i in (1, 2, 3, 4, 6, 7, 8, 9, 10, 11, None, None)], key=repr)


def test_quality_rules(messy, messy_rows, nothing):
    got = rows_of(quality_rules.judge(messy), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got == sorted([(i, *plain.base_quality(t)) for i, t, _ in messy_rows], key=repr)
    assert quality_rules.judge(nothing).collect() == []
    assert quality_rules.judge(messy.drop("lang")).filter("kept = base_failed").isEmpty()


def test_substrings(messy, messy_rows, nothing):
    got = {r[0]: tuple(r)[1:] for r in substring_dedup.cut_repeats(messy.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])).collect()}
    assert got == plain.repeats({i: t for i, t, _ in messy_rows if i is not None}.items(), 100)
    assert substring_dedup.cut_repeats(messy).count() == messy.count()
    assert substring_dedup.cut_repeats(nothing).collect() == []


@pytest.mark.parametrize("k", range(4))
def test_stage_keeps_columns(spark, messy, nothing, tmp_path, bench_items, label_rows, k):
    bench_items.write.parquet(f"{tmp_path}/benchmark.parquet")
    label_rows.write.parquet(f"{tmp_path}/labels.parquet")
    stage = corpus_pipeline.STAGES[k][1]
    got = stage(spark, messy, str(tmp_path))
    assert got.columns == messy.columns and 0 < got.count() <= messy.count()
    assert stage(spark, nothing, str(tmp_path)).collect() == []


def test_whole_pipeline_on_messy_and_empty_tables(spark, messy, messy_rows, nothing, tmp_path, bench_items, label_rows):
    for folder, docs in (("messy", messy), ("empty", nothing)):
        docs.write.parquet(f"{tmp_path}/{folder}/documents.parquet")
        bench_items.write.parquet(f"{tmp_path}/{folder}/benchmark.parquet")
        label_rows.write.parquet(f"{tmp_path}/{folder}/labels.parquet")
    got = corpus_pipeline.run(spark, f"{tmp_path}/messy").collect()
    # of the equal texts of 4, 5 and 5 the first stays; rows without an id, texts without words and harmless ones all stay
    ids = [r.doc_id for r in got if r.piece == 0]
    assert set(ids) - {11} == {i for i, _, _ in messy_rows} - {5, 11} and ids.count(4) == 1 and ids.count(None) == 2
    assert {r.length for r in got if r.doc_id in (1, 2)} == {1} and len({(r.sequence_id, r.offset) for r in got}) == len(got)
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").collect() == []
