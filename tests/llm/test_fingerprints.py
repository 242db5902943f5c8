import hashlib
import random

import pytest
from pyspark.sql import functions as F

from wardflow.llm import fingerprints as fp
from wardflow.llm import queries

SF = "/root/testdata/sf0.01"


def expected(rows):
    """rows in order; each is followed by the next, the last by the first."""
    f, out = fp.Fingerprinter(), []
    for (i, t), (_, n) in zip(rows, rows[1:] + rows[:1]):
        t, n = t or "", n or ""
        k = len(t) // 3
        edited = t[:len(t) - k] + n[:k]
        a, b, c = f.fingerprint(t), f.fingerprint(edited), f.fingerprint(n)
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), f"{a:016x}", f"{b:016x}",
                    1 - bin(a ^ b).count("1") / 64, 1 - bin(a ^ c).count("1") / 64))
    return out


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
            .orderBy(F.col("doc_id").desc()).collect()]
    got = queries.QUERIES["op6_document_fingerprints"](spark, SF).collect()
    want = expected(rows)
    assert sorted(tuple(r)[:7] for r in got) == sorted(want)
    fps = [int(w[3], 16) for w in want]
    for r in got:
        if r.doc_id % 50:
            assert r.n_near is None
        else:
            own = int(r.fingerprint, 16)
            assert r.n_near == sum(bin(own ^ f).count("1") <= 3 for f in fps) - 1
    assert sum(r.near_edited > r.near_next for r in got) > 0.98 * len(got)


def test_edges(spark):
    rows = [(9, "nine words are here for you to read now"), (8, None), (7, ""), (5, "é" * 10), (5, "é" * 10),
            (4, "x"), (3, "long " * 40_000), (None, "the one without an id")]
    df = spark.createDataFrame(rows, "id long, text string").withColumn("part", F.lit("p")).repartition(3)
    got = fp.with_edited(df, "id").collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, expected(rows)))
    one = df.where("id = 9")
    assert [tuple(r) for r in fp.with_edited(one, "id").collect()] == expected(rows[:1])
    none = fp.with_edited(df.limit(0), "id")
    assert none.isEmpty() and fp.neighbour_counts(none, F.lit(True)).isEmpty()


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_search_is_whole(spark, radius):
    rnd = random.Random(radius)
    centres = [rnd.getrandbits(64) for _ in range(4)]
    fps = sorted({c ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 5))) for c in centres for _ in range(120)})
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    df = spark.createDataFrame(signed, "fp long")
    got = {tuple(r) for r in fp.within_radius(df.where("fp % 3 = 0").withColumnRenamed("fp", "q"), df, radius).collect()}
    assert got == {(a[0], b[0]) for a, x in zip(signed, fps) for b, y in zip(signed, fps)
                   if a[0] % 3 == 0 and bin(x ^ y).count("1") <= radius}


def test_fingerprint():
    f = fp.Fingerprinter()
    assert f.fingerprint(None) == f.fingerprint(" \n") == 0
    assert f.fingerprint("A b") == f.fingerprint("a\tB") != f.fingerprint("b a")
