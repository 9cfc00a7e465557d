import pytest

from noticeloom.llm import mixture, quality

needs_files = pytest.mark.skipif(not __import__("os").path.exists(mixture.TOKENIZER), reason="no tokenizer files")
TARGETS = [("big_one", 0.5, 1), ("small", 0.3, 3), ("mid", 0.2, 2), ("absent", 0.1, 5)]


def tables(spark, n=400):
    rows = [(i, f"word {i} and some more text. " * (1 + i % 5), ["Big-One", " big one", "BIG_ONE", "mid", "small"][i % 5] if i % 11 else "small", "extra") for i in range(n)]
    rows += [(None, "x", "mid", ""), (n + 1, None, "mid", ""), (n + 2, "", "small", ""), (n + 3, "other text", "nobody", ""), (n + 4, "other text", None, "")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, key string"), spark.createDataFrame(TARGETS, "source string, target_share double, max_repeats int")


def test_budgets():
    t = {"a": (0.5, 1), "b": (0.5, 2), "c": (0.2, 9)}
    assert mixture.budgets({"a": 100, "b": 10}, t) == pytest.approx({"a": 20, "b": 20})
    assert mixture.budgets({"a": 100, "b": 10}, t, 100) == pytest.approx({"a": 80, "b": 20})
    assert mixture.budgets({"a": 100, "b": 10}, t, 1000) == pytest.approx({"a": 100, "b": 20})
    assert mixture.budgets({}, t) == {}


@needs_files
@pytest.mark.parametrize("total", [None, 4000, 10**7])
def test_shares_and_repeats(spark, total):
    docs, targets = tables(spark)
    m = mixture.mix(docs.unionByName(docs.limit(20)), targets, total=total, ranges=16)
    drawn, report = m.drawn.collect(), {r.source: r for r in m.report.collect()}
    assert len({r.doc_id for r in drawn}) == len(drawn)
    sizes = {r.doc_id: (r.text, r.source) for r in docs.collect()}
    repeats = {s: k for s, _, k in TARGETS}
    assert all(1 <= r.copies <= repeats[r.source] and r.n_tokens == mixture.token_count(sizes[r.doc_id][0]) for r in drawn)
    for s in repeats:
        own = [r for r in drawn if r.source == s]
        assert report[s].drawn_tokens == sum(r.n_tokens * r.copies for r in own)
        assert len({r.copies for r in own}) <= 2  # whole epochs, then a part
    want = mixture.budgets({s: r.tokens for s, r in report.items()}, {s: (share, k) for s, share, k in TARGETS}, total)
    longest = max(r.n_tokens for r in drawn)
    assert all(abs(report[s].drawn_tokens - w) <= longest for s, w in want.items())
    assert report["absent"].drawn_tokens == 0 and report["absent"].share == 0
    if total is None:
        assert all(abs(report[s].share - share / 1.0) < 0.01 for s, share, _ in TARGETS[:3])
    again = mixture.mix(docs, targets, total=total, ranges=16).drawn.collect()
    assert {(r.doc_id, r.copies) for r in again} == {(r.doc_id, r.copies) for r in drawn}


@needs_files
def test_heavier_documents_come_more_often(spark):
    rows = [(i, ("A sentence that ends well. " if i % 2 else "@@ ## %% ~~ ^^ || {} [] ") * 4, "s") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    m = mixture.mix(docs, spark.createDataFrame([("s", 1.0, 1)], "source string, target_share double, max_repeats int"), total=20000)
    good = [r.doc_id % 2 for r in m.drawn.collect()]
    assert sum(good) / len(good) > 0.75


@needs_files
def test_empty_and_long(spark):
    docs, targets = tables(spark, 10)
    assert mixture.mix(docs.limit(0), targets).drawn.count() == 0
    assert mixture.mix(docs, targets.limit(0)).report.count() == 0
    assert mixture.token_count("あ" * 120_000) > 0 and mixture.token_count(None) == 0
    assert quality.COMMON > 0


def test_long_texts_without_blanks_are_counted_whole():
    text = "漢字仮名交じりの文" * 30_000
    whole = len(mixture._encoding(mixture.TOKENIZER).encode_ordinary(text))
    assert mixture.token_count(text) == whole > 200_000


def test_shares_at_scale_and_with_light_documents(spark):
    rows = [(i, "w " * (1 + i % 40) if i % 3 else "; " * (1 + i % 40), f"S-{i % 3}") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    targets = spark.createDataFrame([("s0", 0.5, 2), ("s1", 0.3, 2), ("S 2", 0.2, 2)], "source string, target_share double, max_repeats int")
    got = mixture.mix(docs, targets)
    report = {r.source: r for r in got.report.collect()}
    total = sum(r.drawn_tokens for r in report.values())
    assert all(abs(r.share - r.target_share) < 0.001 and r.most_copies <= 2 for r in report.values())
    copies = {(r.doc_id): r.copies for r in got.drawn.collect()}
    assert sum(mixture.token_count(t) * copies.get(i, 0) for i, t, _ in rows) == total
