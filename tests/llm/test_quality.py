import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from noticeloom.llm import plans, quality, trees


def test_trees_learn_and_calibrate():
    r = np.random.default_rng(1)
    x = r.normal(size=(900, 5))
    y = (x[:, 0] > 0).astype(int) + 2 * (x[:, 1] * x[:, 2] > 0).astype(int)
    forest = trees.fit(x[:600], y[:600], np.ones(600), 4, rounds=30)
    forest = trees.calibrate(forest, x[600:750], y[600:750])
    p = forest.probability(x[750:])
    assert np.allclose(p.sum(axis=1), 1) and (p.argmax(axis=1) == y[750:]).mean() > 0.85
    loss = -np.log(p[np.arange(150), y[750:]] + 1e-9).mean()
    assert loss < 0.6
    assert trees.calibrate(forest, x[:3], y[:3]) is forest


def prose(i):
    return f"The clerk {i} read the letter again before noon. Nobody in the office knew why it had been sent, and the answer was put off until the next day. It rained for {i} hours."


def lines(i):
    return "\n".join(f"- entry {i} {k}" for k in range(4 + i % 5))


def rows(i):
    return "\n".join(f"{i},{k},unit {k},2020-01-0{k}" for k in range(1, 5 + i % 4))


def junk(i):
    return "".join(chr(33 + (i * 7 + k * k) % 60) for k in range(80 + i))


MADE = {"prose": prose, "list": lines, "table": rows, "junk": junk}


def corpus(spark, n=60):
    docs = [(4 * i + k, f(i), "x") for i in range(n) for k, f in enumerate(MADE.values())]
    extra = [(9000, None, "x"), (9001, "", "x"), (9002, " \n\t", "x"), (9003, prose(3) * 400, "x"), (None, prose(1), "x"), (0, prose(0), "x")]
    labels = [(4 * i + k, kind, "a", None) for i in range(0, n, 2) for k, kind in enumerate(MADE)] + [(1, "prose", "b", None), (1, "list", "c", None), (2, None, "d", None)]
    return spark.createDataFrame(docs + extra, "doc_id long, text string, kind string"), spark.createDataFrame(labels, "doc_id long, kind string, annotator string, labelled_at timestamp")


def test_kinds_on_held_out_documents(spark):
    docs, labels = corpus(spark)
    got = quality.kinds(docs, labels).collect()
    assert len(got) == docs.count() and all(math.isclose(sum(r[f"p_{k}"] for k in quality.KINDS), 1, rel_tol=1e-6) for r in got)
    by = {r.doc_id: r.kind for r in got if r.doc_id is not None and r.doc_id}
    held = [(4 * i + k, kind) for i in range(1, 60, 2) for k, kind in enumerate(MADE)]
    assert sum(by[d] == kind for d, kind in held) / len(held) > 0.97
    assert [by[d] for d in (9000, 9001, 9002)] == ["junk"] * 3 and by[9003] in quality.KINDS


def test_kinds_without_labels_or_documents(spark):
    docs, labels = corpus(spark, 12)
    assert quality.kinds(docs, labels.limit(0)).count() == docs.count()
    assert quality.kinds(docs.limit(0), labels).count() == 0


def test_statistics(spark):
    texts = {1: "The cat. The dog!\nno end", 2: "漢字かなカナ、abc。", 3: None, 4: "", 5: "!!! ???", 6: "the cat"}
    df = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id long, text string, n_words int")
    got = {r.doc_id: r for r in quality.statistics(df, share=0.3).collect()}
    assert (got[1].n_words, got[1].mean_word_length, got[1].line_end_share) == (6, 17 / 6, 0.5)
    assert got[1].symbol_share == 2 / 19 and got[1].common_word_share == 1 / 6
    assert (got[2].n_words, got[2].symbol_share, got[2].line_end_share) == (4, 2 / 11, 1.0)
    assert all(tuple(got[i])[1:] == (0, 0.0, 0.0, 0.0, 0.0) for i in (3, 4)) and got[5].symbol_share == 1.0
    assert quality.statistics(df.limit(0)).count() == 0


def test_statistics_equal_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    folder = "/root/testdata/sf0.001"
    if not os.path.exists(folder):
        pytest.skip("no test data")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet')")
    want = con.execute(plans.ORACLES["p8_statistics"]).fetchdf().sort_values("doc_id").reset_index(drop=True)
    got = plans.QUERIES["p8_statistics"](spark, folder).orderBy("doc_id").toPandas()
    assert (got[want.columns].round(9) == want.round(9)).all().all()
    assert spark.range(1).select(F.lit(1)).count() == 1
