import random
import uuid
from functools import reduce

from oracle_util import assert_same, duck
from pyspark.sql import functions as F

from wardflow.llm import chat, licenses, oracle, queries, rollups
from wardflow.session import checkpoint_dir

SF = "/root/testdata/sf0.01"


def test_oracle(spark):
    assert_same(spark, "op2_chat_preferences", SF)


# -- chat -------------------------------------------------------------------

def test_preference_pairs(spark):
    a = [(1, 0, "system", "s"), (1, 1, "user", "hi"), (1, 2, "assistant", "good\n"), (1, 3, "user", "x"), (1, 4, "assistant", "é😀")]
    b = [(1, 0, "system", "s"), (1, 1, "user", "hi"), (1, 2, "assistant", "bad")]
    same = [(2, 0, "user", "q"), (2, 1, "assistant", "a")]
    odd = [(3, None, "user", None), (3, 0, None, "t"), (3, 0, None, "t"), (None, 0, "user", "null pair")]
    schema = "conv_id long, turn long, role string, text string"
    c = spark.createDataFrame(a + same + odd, schema).withColumn("prompt", F.lit(1))
    r = spark.createDataFrame(b + same + [(4, 0, "user", "only rejected")], schema).withColumn("prompt", F.lit(1))
    got = {x.conv_id: x for x in chat.preference_pairs(c, r).collect()}
    assert set(got) == {1, 2, 3, 4, None}
    x = got[1]
    assert x.prompt == "<|system|>\ns<|end|>\n<|user|>\nhi<|end|>\n" and x.prompt_turns == 2 and x.differs
    assert [x.chosen[s.start:s.end] for s in x.chosen_spans] == ["good\n<|end|>\n", "é😀<|end|>\n"]
    assert [x.rejected[s.start:s.end] for s in x.rejected_spans] == ["bad<|end|>\n"]
    assert got[2].prompt_turns == 2 and (got[2].chosen, got[2].rejected, got[2].differs) == ("", "", False)
    assert got[3].prompt == "" and got[3].chosen == "<||>\nt<|end|>\n" * 2 + "<|user|>\n<|end|>\n"
    assert got[4].chosen == "" and got[4].rejected.endswith("only rejected<|end|>\n")
    assert chat.preference_pairs(c.limit(0), r.limit(0)).isEmpty()
    assert chat.preference_pairs(c, r.limit(0)).count() == 4


# -- licenses ---------------------------------------------------------------

def test_known_notices_are_found(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = set()
    for r in rows:
        for name, t in licenses.TEMPLATES.items():
            want |= {(r.doc_id, name) for line in r.text.split("\n") if line == t}
    got = queries.QUERIES["op5_license_scan"](spark, SF).collect()
    assert want and {(g.doc_id, g.license) for g in got if g.license} >= want
    texts = {r.doc_id: r.text for r in rows}
    for g in got:
        block = texts[g.doc_id][g.start:g.end]
        own, template = licenses.wording(block), licenses.wording(licenses.TEMPLATES[g.top_template])
        if g.license:
            assert len(g.missing) + len(g.extra) <= 0.05 * max(len(template), len(own))
    assert all(g.license for g in got if texts[g.doc_id][g.start:g.end] in licenses.TEMPLATES.values())


def test_license_wording(spark):
    notice = licenses.TEMPLATES["MIT-notice"]
    texts = [
        "intro\n" + notice.replace("hereby granted", "granted") + "\nend",
        "This work is licensed under the GNU General Public License, version 4.",
        "Code here: Licensed under CC BY-NC 4.0. Enjoy.\nCopyright 2020\n\nall rights reserved",
        None, "", "nothing here", "x " * 50_000 + "\nReleased under the MIT License.\n" + "y " * 50_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("rank", F.lit("r"))
    got = licenses.license_blocks(df).collect()
    by = {(g.doc_id, g.block): g for g in got}
    assert set(by) == {(0, 0), (1, 0), (2, 0), (2, 1), (6, 0)}
    assert by[0, 0].license == "MIT-notice" and by[0, 0].missing == ["hereby"]
    assert by[1, 0].license is None and by[1, 0].top_template.startswith("GPL")
    assert by[2, 0].license == "CC-BY-NC-4.0" and by[2, 1].license is None
    assert by[6, 0].license == "MIT" and by[6, 0].start == 100_001
    assert licenses.license_blocks(df.limit(0)).isEmpty()
    for name, t in licenses.TEMPLATES.items():
        assert licenses.Scanner(licenses.TEMPLATES).notices(t)[0][0] == name


# -- rollups ----------------------------------------------------------------

def test_rollup_follows_the_documents(spark):
    rnd = random.Random(5)
    path = f"{checkpoint_dir(spark)}/rollup-{uuid.uuid4().hex}"
    live, schema = {}, "source string, lang string, tokenizer string, n_tokens long, n_docs string"
    keys = [(s, g, t) for s in ("hot", "b", None) for g in ("en", None) for t in ("v1", "v2")]

    def frame(rows):
        return spark.createDataFrame([(*k, n, "clash") for k, n in rows], schema)
    rollup = rollups.TokenRollup(spark, path)
    assert rollup.totals().isEmpty()
    for batch in range(4):
        new = {(batch, i): (rnd.choice(keys), rnd.randint(0, 50)) for i in range(40)}
        dead = rnd.sample(sorted(live), len(live) // 3)
        changed = {d: (live[d][0], rnd.randint(0, 50)) for d in live if d not in dead and rnd.random() < 0.4}
        deltas = rollups.changes(frame([live[d] for d in [*dead, *changed]]), frame([*new.values(), *changed.values()]))
        assert rollup.commit(f"b/{batch}", deltas)
        assert not rollup.commit(f"b/{batch}", deltas)
        live = {d: v for d, v in live.items() if d not in dead} | changed | new
        want = {}
        for k, n in live.values():
            a = want.setdefault(k, [0, 0])
            a[0] += 1
            a[1] += n
        got = {tuple(r)[:3]: list(r)[3:] for r in rollups.TokenRollup(spark, path).totals().collect()}
        assert got == want
    # a batch that failed before its success mark does not count and can be sent again
    spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).delete(
        spark._jvm.org.apache.hadoop.fs.Path(f"{rollup._folder('b/0')}/_SUCCESS"), False)
    assert not rollup.committed("b/0")


#: Tokens by a pattern: what SQL can count, too.
PATTERNS = {"words-1": r"[^\x20\x09-\x0D]+", "pieces-2": r"[\p{L}\p{N}]+|[^\p{L}\p{N}\x09-\x0D\x20]"}


def test_batches_against_sql(spark):
    """The three batches with tokens counted by patterns, against DuckDB."""
    bucket = F.crc32(F.col("doc_id").cast("string")) % 10
    rest = F.expr("if(contains(text, '\n'), substr(text, instr(text, '\n') + 1), text)")

    def count(text, p):
        return F.coalesce(F.regexp_count(text, F.lit(p)), F.lit(0)).cast("long")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = reduce(lambda a, b: a.union(b), [
        docs.select("source", "lang", bucket.alias("bucket"), F.lit(v).alias("tokenizer"), count(F.col("text"), p).alias("n_tokens"),
                    count(rest, p).alias("n_revised")) for v, p in PATTERNS.items()])
    got = queries._three_batches(counts)
    want = duck(SF).execute(oracle.TOKEN_COUNTS).fetchall()
    cols = ["source", "lang", "tokenizer", "n_docs", "n_tokens"]
    assert sorted(map(tuple, got.select(*cols).collect()), key=str) == sorted(want, key=str)


def plain_counts(text):
    """Tokens of a text by the libraries' own tokenizers."""
    import public_tokenizers
    from tokenizers import Tokenizer
    if not hasattr(plain_counts, "kept"):
        plain_counts.kept = {}
        for v, file in ((rollups.TOKENIZERS[0], "word_bpe_49k.json"), (rollups.TOKENIZERS[1], "byte_bpe_50k.json")):
            plain_counts.kept[v] = Tokenizer.from_file(public_tokenizers.path(file))
        # special tokens are ordinary text to the ranks of the second
        plain_counts.kept[rollups.TOKENIZERS[1]].encode_special_tokens = True
    return {v: len(t.encode(text or "", add_special_tokens=False).ids) for v, t in plain_counts.kept.items()}


def test_query_against_plain_counts(spark):
    import zlib
    sf = "/root/testdata/sf0.001"
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        bucket = zlib.crc32(str(r.doc_id).encode()) % 10
        text = r.text
        if bucket == 5 and text and "\n" in text:
            text = text[text.index("\n") + 1:]
        for v, n in plain_counts(text).items() if bucket != 3 else ():
            a = want.setdefault((r.source, r.lang, v), [0, 0])
            a[0] += 1
            a[1] += n
    got = queries.QUERIES["op9_token_counts"](spark, sf)
    assert {(r.source, r.lang, r.tokenizer): [r.n_docs, r.n_tokens] for r in got.collect()} == want


def test_count_tokens(spark):
    texts = [None, "", " \n\t ", "it's 5\u20ac \x0b x", "<|endoftext|> and", "word " * 100_000, "a" * 20_000, "x", "x"]
    df = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "k long, t string, tokenizer long")
    got = rollups.with_token_counts(df, [F.col("k")], {"n": F.col("t"), "m": F.lit(None).cast("string")}).collect()
    assert len(got) == 2 * len(texts) and {r.m for r in got} == {0}
    for r in got:
        assert r.n == plain_counts(texts[r.k])[r.tokenizer] or (r.k == 4 and r.tokenizer == rollups.TOKENIZERS[0])
    assert rollups.with_token_counts(df.limit(0), [F.col("k")], {"n": F.col("t")}).isEmpty()


def test_compaction_and_lost_races(spark):
    path = f"{checkpoint_dir(spark)}/rollup-{uuid.uuid4().hex}"
    rollup = rollups.TokenRollup(spark, path)

    def rows(*n):
        return spark.createDataFrame([("a.b", None, "v", k) for k in n], "source string, lang string, tokenizer string, n_tokens long")

    def totals():
        return [tuple(r) for r in rollups.TokenRollup(spark, path).totals().collect()]
    rollup.compact()
    assert rollup.totals().isEmpty()
    assert rollup.commit("empty", rollups.changes(None, rows().limit(0))) and rollup.totals().isEmpty()
    for k in range(3):
        assert rollup.commit(f"x/{k}", rollups.changes(None, rows(k, 10)))
        rollup.compact()
        assert totals() == [("a.b", None, "v", 2 * (k + 1), sum(range(k + 1)) + 10 * (k + 1))]
    # merged batches are known though their folders are gone
    assert not rollup.commit("x/0", rollups.changes(None, rows(1)))
    assert not rollup._fs.exists(rollup._path(rollup._folder("x/0")))
    assert sorted(rollup._names("base")) == ["2", "3"]
    # another writer commits the same batch between this one's look and its rename
    staged = rollup._stage(rollups.changes(None, rows(5)))
    assert rollup.commit("y", rollups.changes(None, rows(7)))
    assert not rollup._rename(staged, rollup._folder("y"))
    assert totals() == [("a.b", None, "v", 7, 40)]
    # a batch that was only staged does not count
    rollup._stage(rollups.changes(None, rows(1000)))
    assert totals() == [("a.b", None, "v", 7, 40)] and not rollup.committed("z")
