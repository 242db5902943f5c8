import numpy as np
import pytest
from pyspark.sql import functions as F

from wardflow.llm import langid, queries

SF = "/root/testdata/sf0.01"


def test_gradients_match_differences():
    rnd = np.random.default_rng(0)
    m = langid.new_model(["a", "b", "c"], 3, rnd)
    m = langid.Model(m.langs, langid.Cell(*[w.astype(np.float64) for w in m.ahead]),
                     langid.Cell(*[w.astype(np.float64) for w in m.back]), m.out.astype(float), m.bias.astype(float))
    x = rnd.integers(97, 103, (9, 5)).astype(np.uint8)
    real = np.ones((9, 5), np.float32)
    real[6:, 1] = 0
    y = rnd.integers(0, 3, 5)
    _, grads = langid.gradients(m, x, real, y)
    for p, g in zip([*m.ahead, *m.back, m.out, m.bias], grads):
        hot = np.argsort(-np.abs(g), axis=None)[:4]
        for at in hot:
            at = np.unravel_index(at, p.shape)
            old, eps = p[at], 1e-3
            p[at] = old + eps
            up = langid.gradients(m, x, real, y)[0]
            p[at] = old - eps
            down = langid.gradients(m, x, real, y)[0]
            p[at] = old
            assert g[at] == pytest.approx((up - down) / (2 * eps), rel=0.05, abs=2e-4)


def test_held_out_accuracy(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    rows = queries.QUERIES["op7_language_id"](spark, SF).collect()
    assert len(rows) == len(lang)
    held = [r for r in rows if r.held_out and r.lang_pred != "und"]
    right = np.mean([r.lang_pred == lang[r.doc_id] for r in held])
    assert len(held) > 150 and right > 0.97, right
    assert all(0 <= r.score <= 1 and 0 <= r.lang_share <= 1 for r in rows)


def test_edges(spark):
    en, de = "the cat and the dog went to the house " * 3, "die Katze und der Hund ging über das Haus " * 3
    docs = [(i, en if i % 2 else de, "en" if i % 2 else "de") for i in range(120)]
    more = [(900, None, "en"), (901, "", "de"), (902, "12 345 _ ² ½", None), (903, de * 2000, None), (None, en, "xx"),
            (904, en, None), (904, en, None)]
    df = spark.createDataFrame(docs + more, "doc_id long, text string, lang string").withColumn("score", F.lit("s"))
    model = langid.learn_from_open(df)
    assert model.langs == ["de", "en"]
    got = {(r.doc_id, r.text): r['__lang_pred'] for r in langid.predict(df, model, F.col("text")).collect()}
    assert got[900, None] == got[901, ""] == got[902, "12 345 _ ² ½"] == "und"
    assert got[903, de * 2000] == "de" and got[904, en] == got[None, en] == "en"
    none = langid.learn_from_open(df.withColumn("lang", F.lit(None).cast("string")))
    assert none is None and {r['__lang_pred'] for r in langid.predict(df, none, F.col("text")).collect()} == {"und"}
    assert langid.predict(df.limit(0), model, F.col("text")).isEmpty()


def test_whole_text_in_blocks():
    rnd = np.random.default_rng(1)
    m = langid.new_model(["a", "b"], 4, rnd)
    text = bytes(rnd.integers(32, 127, 64 * 5 + 17).astype(np.uint8))
    p, votes = langid.label(m, [text, b"q"])
    parts = [text[i:i + 64] for i in range(0, len(text), 64)]
    own = [langid.label(m, [t])[0][0] * len(t) for t in parts]
    assert p[0] == pytest.approx(sum(own) / len(text), rel=1e-4)
    assert votes[0].sum() == len(text) and votes[1].sum() == 1


def test_a_pass_over_texts_is_held_to_a_few_blocks():
    import tracemalloc
    model = langid.new_model(["a", "b", "c", "d", "e"], langid.HIDDEN, np.random.default_rng(1))
    texts = [b"some words here " * 128] * (langid.BYTES_AT_ONCE // 2048)
    tracemalloc.start()
    pooled, _ = langid.label(model, texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 48 << 20 and len(pooled) == len(texts)


def test_a_named_text_column_is_sent_once(spark):
    df = spark.createDataFrame([(1, "ab ab ab", "x"), (2, None, "y"), (3, "zz", None)], "doc_id long, text string, other string")
    model = langid.new_model(["a", "b"], 4, np.random.default_rng(2))
    by_name, by_column = langid.predict(df, model, "text"), langid.predict(df, model, F.col("text"))
    assert sorted(map(str, by_name.collect())) == sorted(map(str, by_column.collect()))
    assert "__text" not in by_name._jdf.queryExecution().optimizedPlan().toString()
