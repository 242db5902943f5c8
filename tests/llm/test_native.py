import re

import pytest
from oracle_util import assert_same
from pyspark.sql import functions as F

from wardflow.llm import common, line_dedup, mixing, quality

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op3_source_mix", "op4_quality_rules", "op10_line_dedup"])
@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_oracle(spark, name, sf):
    assert_same(spark, name, f"/root/testdata/sf{sf}")


# -- mixing -----------------------------------------------------------------

def test_targets_reshare_excess(spark):
    sizes = {"a": 10, "b": 1000, "c": 1000, "d": 5, "e": 0, None: 2000}
    got = {r.source: r.target for r in mixing.source_targets(
        spark.createDataFrame(list(sizes.items()), "source string, source_size long"), (5, 2, 1), 1.5, 2.0).collect()}
    names = sorted(n for n in sizes if n) + [None]
    w = dict(zip(names, [5, 2, 1, 5, 2, 1]))
    want, open_, left = {}, set(names), 1.5 * sum(sizes.values())
    while True:
        share = {n: left * w[n] / sum(w[m] for m in open_) for n in open_}
        above = {n for n in open_ if share[n] > 2 * sizes[n]}
        if not above:
            break
        for n in above:
            want[n] = 2.0 * sizes[n]
        left -= sum(want[n] for n in above)
        open_ -= above
    assert got == pytest.approx(want | share)
    assert sum(got.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_mix_is_whole_and_repeatable(spark, monkeypatch):
    rows = [(i, "w " * (i % 7), f"s{i % 3}" if i % 10 else None, i) for i in range(600)] + [(None, None, None, 0)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    a = mixing.with_copies(df).collect()
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)  # as with very many sources
    assert sorted(map(str, mixing.with_copies(df).collect())) == sorted(map(str, a))
    monkeypatch.undo()
    assert sorted(map(str, a)) == sorted(map(str, mixing.with_copies(df.repartition(7)).collect()))
    assert len(a) == len(rows) and all(0 <= r["__copies"] <= 2 for r in a)
    for r in a:  # floor(rate) copies and at most one more
        rate = r["__target"] / r["__source_size"]
        assert int(rate) <= r["__copies"] <= int(rate) + 1
    out = mixing.mixed(df)
    assert out.columns == df.columns and out.count() == sum(r["__copies"] for r in a)
    assert mixing.mixed(df.limit(0)).isEmpty()
    assert mixing.mixed(df.withColumn("text", F.lit(None).cast("string"))).isEmpty()


@pytest.mark.parametrize("row", ["one row", "one id"])
def test_a_source_of_repeated_rows_meets_its_target(spark, row, monkeypatch):
    rows = [(i, f"w{i} x y z", s, i) for i in range(2000) for s in "ac"]
    rows += [(7, "w7 x y z" if row == "one row" else f"w{i} x y z", "b", i) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, `a.b` long")
    got = mixing.with_copies(df, weights=(1, 1, 1), share=1.25).cache()
    taken = {r.source: (r.taken, r.target) for r in got.groupBy("source").agg(
        F.sum(F.expr("__copies * __size")).alias("taken"), F.max("__target").alias("target")).collect()}
    for taken_, target in taken.values():
        assert abs(taken_ - target) < 0.05 * target
    cols = ["doc_id", "text", "source", "__copies"]
    monkeypatch.setattr(mixing, "REPEAT_PARTS", 3)  # parts and partitions change nothing
    again = mixing.with_copies(df.repartition(5), weights=(1, 1, 1), share=1.25)
    assert sorted(map(str, again.select(cols).collect())) == sorted(map(str, got.select(cols).collect()))


def test_mix_keeps_columns_of_any_name(spark):
    names = ["a.b", "__size", "__draw", "__copies", "__name", "__nth", "__key", "__of", "__id", "__row", "__target", "id"]
    df = spark.createDataFrame([(i, "w w", f"s{i % 2}", *[f"{n} {i}" for n in names]) for i in [1, 1, *range(2, 60)]],
                               ["doc_id", "text", "source", *names])
    out = mixing.mixed(df, share=2.0)
    assert out.columns == df.columns
    rows = set(map(tuple, df.collect()))
    assert out.count() and all(tuple(r) in rows for r in out.collect())
    with pytest.raises(ValueError):
        mixing.with_copies(df)


# -- quality ----------------------------------------------------------------

def plain_measures(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, covered = {}, set()
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i:i + 8]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            covered |= {p for i in at for p in range(i, i + 8)}
    return (len(w), len("".join(w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_measures(spark):
    texts = [None, "", " \n\t ", "a " * 7, "a " * 8, "a " * 9, "x y z\n \nx y z\n x y z", "é# <b>|\x0b%&$*\r",
             " ".join(map(str, range(30))) + " Q " + " ".join(map(str, range(5, 25))) + "\n" + "TOP! " * 3,
             " ".join(str(i % 501) for i in range(30_000))]
    df = spark.createDataFrame([(i, t, "n") for i, t in enumerate(texts)] * 2, "doc_id long, text string, n_words string")
    got = [(r["__id"], r[1:6]) for r in quality.ledger(df).collect()]
    assert sorted(got) == sorted([(i, plain_measures(t)) for i, t in enumerate(texts)] * 2)
    assert quality.ledger(df.limit(0)).isEmpty()


def test_ablations(spark):
    bits = [0, 0, 1, 3, 4, 4, 8, 12, 64, 1 << 40]
    led = spark.createDataFrame([(b,) for b in bits], "fail_bits long")
    for version, names in quality.POLICIES.items():
        got = {r.rule: tuple(r)[1:] for r in quality.ablations(led, version).collect()}
        whole = quality.mask(names)
        assert got == {n: (sum(b & quality.mask([n]) != 0 for b in bits), sum(b & whole == 0 for b in bits),
                           sum(b & whole & ~quality.mask([n]) == 0 for b in bits)) for n in names}
        assert all(r[1:] == (0, 0, 0) for r in quality.ablations(led.limit(0), version).collect())


# -- line dedup -------------------------------------------------------------

def plain_line_dedup(rows):
    """rows: (id, text) with distinct pairs, ids distinct."""
    seen, gone = set(), {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        at = [j for j, x in enumerate((t or "").split("\n")) if x.strip(" \t\n\x0b\f\r")]
        ls = (t or "").split("\n")
        for w in range(len(at) - 2):
            key = tuple(ls[j] for j in at[w:w + 3])
            if key in seen:
                gone.setdefault(i, set()).update(at[w:w + 3])
            seen.add(key)
    return {i: t if t is None else "\n".join(x for j, x in enumerate(t.split("\n")) if j not in gone.get(i, ()))
            for i, t in rows}


def test_line_dedup(spark):
    shared = "one\ntwo\nthree"
    rows = [(1, f"intro\n{shared}\nend"), (2, f"other\n{shared}\nmore\n\n{shared}"), (3, shared), (4, None), (5, ""),
            (6, "a\na\na\na\na"), (7, "two\nthree"), (8, "one\n \ntwo\nthree\nfour"), (None, "x\n" + shared),
            (9, "\n".join(f"l{i % 700}" for i in range(5000)))]
    df = spark.createDataFrame([(i, t, "L", 1) for i, t in rows], "doc_id long, text string, lines string, w int")
    out = line_dedup.without_repeated_lines(df)
    assert out.columns == df.columns + ["__n_lines", "__n_removed"]
    assert {r.doc_id: r.text for r in out.collect()} == plain_line_dedup(rows)
    twice = line_dedup.without_repeated_lines(df.union(df)).collect()  # repeated rows count once
    assert len(twice) == 2 * len(rows) and {r.doc_id: r.text for r in twice} == plain_line_dedup(rows)
    assert line_dedup.without_repeated_lines(df.limit(0)).isEmpty()
    names = ["a.b", "id", "hash", "covered", "at", "stay", "__row", "gone_id", "__covered"]
    more = line_dedup.without_repeated_lines(df.withColumns({n: F.lit(n) for n in names})).drop("__n_lines", "__n_removed")
    assert {tuple(r) for r in more.collect()} == {(i, t, "L", 1, *names) for i, t in plain_line_dedup(rows).items()}
    with pytest.raises(ValueError, match="__n_lines"):
        line_dedup.without_repeated_lines(df.withColumn("__n_lines", F.lit(1)))
