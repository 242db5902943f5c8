"""The pipeline against plain Python, stage by stage, each on its own input."""

import hashlib

import corpus_pipeline as cp
import pytest
from pyspark.sql import functions as F
from test_native import plain_line_dedup
from test_packing import check, tok  # noqa: F401
from test_simhash_dedup import plain_fingerprint, plain_roots

from wardflow.llm import langid

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Every stage's input and the last one's output."""
    base = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("size", F.lit("extra")).withColumn("__other", F.lit(1))
    odd = spark.createDataFrame([(9001, None, None, None, None), (9002, "", "en", "src1", 0), (9003, "1 2 3", "en", None, 5)],
                                "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.unionByName(odd.withColumns({"size": F.lit(None).cast("string"), "__other": F.lit(2)}))
    # names that stages use themselves, and one with a dot
    docs = docs.withColumns({n: F.concat(F.lit(n), F.coalesce(F.col("doc_id"), F.lit(0)).cast("string")) for n in (
        "a.b", "row", "id", "__row", "__id", "__text", "__text_hash", "__size", "__draw", "__copies", "__at", "__all",
        "__covered", "__n_lines", "__n_removed", "__lang_pred", "__score", "__key_text")})
    out = [docs]
    for i, (_, f) in enumerate(cp.STAGES):
        df = f(spark, out[-1], SF)
        if i < len(cp.STAGES) - 1:
            assert df.columns == docs.columns and df.dtypes == docs.dtypes
        df.write.parquet(f"{base}/{i}")
        out.append(spark.read.parquet(f"{base}/{i}"))
    return [d.collect() for d in out]


def key(rows):
    return sorted(map(str, rows))


def test_language_stage(stages, spark):
    before, after = stages[0], stages[1]
    kept = {r.doc_id for r in after}
    assert key(after) == key(r for r in before if r.doc_id in kept)
    letters = {r.doc_id for r in before if r.text and langid.LETTER.search(r.text)}
    assert kept <= letters and len(kept) > 0.95 * len(letters)


def test_line_stage(stages):
    before, after = stages[1], {r.doc_id: r for r in stages[2]}
    text = plain_line_dedup([(r.doc_id, r.text) for r in before])
    for r in before:
        left = text[r.doc_id]
        if left != r.text and not left.strip():
            assert r.doc_id not in after
        else:
            assert after[r.doc_id].text == left
            assert after[r.doc_id].n_chars == (len(left) if left != r.text else r.n_chars)
    assert len(after) <= len(before)


def test_near_dup_stage(stages):
    before = sorted(stages[2], key=lambda r: r.doc_id)
    roots = plain_roots([plain_fingerprint(r.text) for r in before], 2)
    assert key(stages[3]) == key(before[i] for i in sorted(set(roots)))


def test_mix_stage(stages):
    before, after = stages[3], stages[4]
    size = {r.doc_id: len((r.text or "").encode().split()) for r in before}
    total = {}
    for r in before:
        total[r.source] = total.get(r.source, 0) + size[r.doc_id]
    names = sorted(n for n in total if n is not None) + [None] * (None in total)
    w = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    target, open_, left = {}, set(names), 1.5 * sum(total.values())
    while True:
        share = {n: left * w[n] / sum(w[m] for m in open_) for n in open_}
        above = {n for n in open_ if share[n] > 2 * total[n]}
        if not above:
            break
        target |= {n: 2.0 * total[n] for n in above}
        left -= sum(target[n] for n in above)
        open_ -= above
    target |= share
    want, seen = [], {}
    for r in before:
        rate = target[r.source] / total[r.source] if total[r.source] else 0
        name = f"mix:{'~' if r.doc_id is None else r.doc_id}:{'~' if r.text is None else hashlib.md5(r.text.encode()).hexdigest()}"
        nth = seen[r.source, name] = seen.get((r.source, name), -1) + 1
        u = int(hashlib.md5((name + (f":{nth}" if nth else "")).encode()).hexdigest()[:13], 16) / 2 ** 52
        want += [r] * (int(rate) + (u < rate - int(rate)))
    assert key(after) == key(want)


def test_packing_stage(stages, tok):  # noqa: F811
    rows, docs = stages[5], [(r.doc_id, r.text) for r in stages[4]]
    n, bound = check(rows, docs, tok, 2048)
    assert n <= 1.05 * bound + 1 and len({r.copy_row for r in rows}) == len(rows)


def test_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, f in cp.STAGES:
        out = f(spark, docs, SF)
        assert out.isEmpty()


def test_other_columns_keep_their_values(stages):
    for rows in stages[:-1]:
        for r in rows:
            for n in r.asDict():
                if n in ("a.b", "row", "id") or n.startswith("__") and n != "__other":
                    assert r[n] == f"{n}{r.doc_id or 0}"


def test_stages_keep_rows_that_repeat(spark):
    """Two equal rows: both pass or both go, but for near-dedup, where one stays."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    twice = docs.union(docs)
    for name, stage in cp.STAGES[:2]:
        once, both = stage(spark, docs, SF).collect(), stage(spark, twice, SF).collect()
        assert {r.doc_id for r in once} == {r.doc_id for r in both} and len(both) == 2 * len(once), name
    kept = cp.near_dedup(spark, twice, SF).collect()
    assert len(kept) == len({r.doc_id for r in kept}) == cp.near_dedup(spark, docs, SF).count()
    for name, stage in cp.STAGES:
        assert stage(spark, docs.limit(0), SF).isEmpty(), name
