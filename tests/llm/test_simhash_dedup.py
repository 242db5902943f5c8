import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from wardflow.llm import queries, simhash_dedup as sd
from wardflow.llm.components import connected_components

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text, n=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] if len(w) >= n else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_roots(fps, k):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i] = root[root[i]]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= k:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_query_matches_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    roots = plain_roots(fps, 2)
    got = {r.doc_id: r for r in queries.QUERIES["op1_simhash_dedup"](spark, SF).collect()}
    assert len(got) == len(rows)
    for r, f, root in zip(rows, fps, roots):
        assert got[r.doc_id].fingerprint == f"{f:016x}"
        assert got[r.doc_id].component_id == rows[root].doc_id


@pytest.mark.parametrize("k", [0, 1, 2, 3])
@pytest.mark.parametrize("flips", [1, 3, 6])
def test_linked_pairs_in_dense_balls(spark, k, flips):
    """Hundreds of fingerprints around few centres: the hot buckets are cut again."""
    rnd = random.Random(k * 10 + flips)
    fps = set()
    for _ in range(2):
        c = rnd.getrandbits(64)
        low = flips < 6  # all differences in one half: the other half is one hot bucket
        for _ in range(250):
            fps.add(c ^ sum(1 << b for b in rnd.sample(range(32 if low else 64), rnd.randint(0, flips))))
    fps = sorted(fps)
    want = {(min(signed(a), signed(b)), max(signed(a), signed(b))) for i, a in enumerate(fps) for b in fps[:i]
            if bin(a ^ b).count("1") <= k}
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    assert {tuple(r) for r in sd.linked_pairs(df, k).collect()} == want


def test_components(spark):
    e = [(1, 2), (3, 2), (3, 4), (9, 8), (8, 9), (7, 7), (None, 5)] + [(i, i + 1) for i in range(20, 40)]
    got = dict(connected_components(spark.createDataFrame(e, "x long, y long"), "x", "y").collect())
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 8: 8, 9: 8} | {i: 20 for i in range(20, 41)}
    assert connected_components(spark.createDataFrame([], "x long, y long"), "x", "y").isEmpty()


def test_fingerprint_edges():
    assert sd.fingerprint(None) == sd.fingerprint("") == sd.fingerprint(" \n") == 0
    rnd = np.random.default_rng(1)
    long = " ".join(f"w{i}" for i in rnd.integers(0, 5000, 200_000))
    for t in ["One", "A b", "É a\x0bB c d", "x " * 7, long]:
        assert sd.fingerprint(t) == plain_fingerprint(t)


def test_groups_and_kept_rows(spark):
    a = "one two three four five six seven eight"
    rows = [(5, a, "x"), (3, a.upper(), "y"), (3, a.upper(), "y"), (9, None, "z"), (7, "  ", None),
            (None, a, "n"), (None, "quite another text altogether here", "m"), (11, "other words here entirely", "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n string").withColumn("hot", F.lit(1))
    g = {(r["__id"], r["__component"]) for r in sd.near_dup_groups(df).collect()}
    assert g == {(5, 3), (3, 3), (None, 3), (9, 7), (7, 7), (None, None), (11, 11)}
    kept = sd.keep_one_per_group(df)
    assert kept.columns == df.columns
    assert sorted((str(r.doc_id), r.n) for r in kept.collect()) == [("11", "q"), ("3", "y"), ("7", None), ("None", "m")]
    empty = df.limit(0)
    assert sd.near_dup_groups(empty).isEmpty() and sd.keep_one_per_group(empty).isEmpty()
