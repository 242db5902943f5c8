"""Operators 11 to 13 against DuckDB and plain Python."""

import zlib
from collections import Counter, defaultdict

import pytest
from oracle_util import assert_same

from wardflow.llm import decontaminate, divergence, queries, spelling

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_spelling_variants", "op12_benchmark_decontamination", "op13_source_divergence"])
def test_oracle(spark, name):
    assert_same(spark, name, SF)


# -- spelling variants ------------------------------------------------------

def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(words, ratio=10):
    form, n_near = {}, {}
    for w, n in words.items():
        by = sorted((-words[x], x) for x in words if near(w, x))
        n_near[w] = len(by)
        form[w] = by[0][1] if by and -by[0][0] >= ratio * n else None

    def root(w):
        return w if form[w] is None else root(form[w])
    return {(w, form[w], root(w), n, n_near[w], words[form[w]] if form[w] else None) for w, n in words.items()}


def misspelt(w):
    """Every kind of single edit of a word, at every place."""
    for i in range(len(w) + 1):
        yield w[:i] + "q" + w[i:]
        if i < len(w):
            yield w[:i] + w[i + 1:]
            yield w[:i] + "é" + w[i + 1:]
            yield w[:i] + w[i] + w[i:]


def test_variants_are_those_of_all_pairs(spark):
    base = ["thation", "aaaaaaa", "aaaaaaaa", "abababab", "anananan", "strasse", "öffnungen", "cióncióncas", "zzzzyyyy", "x" * 60]
    words = Counter()
    for k, w in enumerate(base):
        words[w] += 10 ** (k % 4 + 1)
        for j, v in enumerate(misspelt(w)):
            if len(v) >= 4:
                words[v] += 1 + j % 11
    df = spark.createDataFrame([(w, n, "key") for w, n in words.items()], "word string, n long, key string")
    got = spelling.variants(df).collect()
    assert len(got) == len(words) and {tuple(r) for r in got} == plain_variants(words)


def test_chains_reach_their_root(spark):
    words = {"abcdefg" + "h" * k: 3 * 10 ** k for k in range(9)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert {r.root for r in spelling.variants(df).collect()} == {"abcdefghhhhhhhh"}


def test_variants_of_little(spark):
    df = spark.createDataFrame([("lonely", 5)], "word string, n long")
    assert [tuple(r) for r in spelling.variants(df).collect()] == [("lonely", None, "lonely", 5, 0, None)]
    assert spelling.variants(df.limit(0)).isEmpty()
    with pytest.raises(Exception, match="code points"):
        spelling.variants(spark.createDataFrame([("abc", 5)], "word string, n long"))


def test_word_counts(spark):
    texts = [None, "", "ABCDEFG abcdefg ÉTOILES étoiles short", "abcdefg-abcdefgh_abcdefgh×abc " * 3000]
    rows = [(i if i != 2 else None, t, 1, "x") for i, t in enumerate(texts)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, run int, `a.b` string")
    want = Counter()
    for t in texts * 2:
        for run in spelling_runs(t or ""):
            want[run] += 1
    assert {tuple(r) for r in spelling.word_counts(df).collect()} == {(w, n) for w, n in want.items() if len(w) >= 7 and n >= 2}
    # the queries' misprints
    want = Counter()
    for i, t, *_ in rows:
        for run in spelling_runs(t or ""):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            want[run if h % 31 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    got = spelling.word_counts(df, edit=queries._misprint).collect()
    assert {tuple(r) for r in got} == {(w, n) for w, n in want.items() if len(w) >= 7 and n >= 2}


def spelling_runs(text):
    out, run = [], ""
    for ch in text + " ":
        if ch.isascii() and ch.isalpha() or "À" <= ch <= "ÿ":
            run += ch.lower() if ch.isascii() else ch
        elif run:
            out.append(run)
            run = ""
    return out


# -- decontamination --------------------------------------------------------

def plain_words(text):
    out, word = [], ""
    for ch in (text or "") + " ":
        if ch > "\x7f" or ch.isalnum():
            word += ch.lower() if ch <= "\x7f" else ch
        elif word:
            out.append(word)
            word = ""
    return out


def plain_hits(text, items, n=10):
    ws = plain_words(text)
    covered, names = set(), set()
    for i, t in items:
        iw = plain_words(t)
        k = min(n, len(iw))
        windows = {tuple(iw[j:j + k]) for j in range(len(iw) - k + 1)} if iw else ()
        for j in range(len(ws) - k + 1):
            if iw and tuple(ws[j:j + k]) in windows:
                covered |= set(range(j, j + k))
                names.add("" if i is None else str(i))
    return len(ws), sorted(covered), sorted(names)


ITEMS = [(1, "The quick Brown fox jumps over the lazy dog, and then it sleeps all day."), (2, "Short one here"), (10, "Ünter den Linden"),
         (3, None), (4, " ... "), (None, "one two three four five six seven eight nine ten"), (5, "a a a a a a a a a a a a"),
         (1, "a second text of the first item that has more than ten words in it")]
TEXTS = [None, "", "!!!", "Short-one\nhere", "short one", "x " * 40 + "THE QUICK brown fox; jumps over the lazy dog and THEN" + " y" * 30,
         "ünter den linden", "Ünter  den\tlinden!", "a " * 25, "a " * 9, "zero one two three four five six seven eight nine ten eleven",
         "it has a second text of the first item that has more than ten words, short one here",
         "pad " * 30000 + "short one here" + " pad" * 30000]


def test_hits(spark):
    items = spark.createDataFrame([(i, t, 7) for i, t in ITEMS], "item_id int, text string, words int")
    rows = [(i if i != 6 else None, t, "n") for i, t in enumerate(TEXTS)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, `n.words` string")
    got = decontaminate.hits(df, items).collect()
    want = [(i, *plain_hits(t, ITEMS)) for i, t, _ in rows]
    key = lambda r: str(r)
    assert sorted([(r["__id"], r["n_words"], r["covered"], r["items"]) for r in got], key=key) == sorted(want, key=key)
    assert decontaminate.hits(df.limit(0), items).isEmpty()
    assert all(not r.covered and not r["items"] for r in decontaminate.hits(df, items.limit(0)).collect())


def test_a_small_table_of_bits_loses_nothing(spark, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    want = {str(r) for r in decontaminate.hits(df, items).collect()}
    monkeypatch.setattr(decontaminate, "LEAST_BITS", 64)
    monkeypatch.setattr(decontaminate, "MOST_BITS", 64)
    assert {str(r) for r in decontaminate.hits(df, items).collect()} == want


def test_spans_and_documents_go(spark):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten"), (2, "Last words")], "item_id int, text string")
    texts = {1: "Intro; one two, three four five six seven eight nine TEN. Outro (last\nwords)", 2: "clean text", 3: None,
             4: "one two three four five six seven eight nine ten!", 5: "  Ein Bär  "}
    df = spark.createDataFrame([(i, t, "L", 1, 2) for i, t in texts.items()], "doc_id long, text string, `a.b` string, row int, covered int")
    out = decontaminate.decontaminated(df, items, max_share=None)
    assert out.columns == df.columns
    assert {r.doc_id: r.text for r in out.collect()} == texts | {1: "Intro; . Outro ()", 4: "!"}
    assert {(r["a.b"], r["row"], r["covered"]) for r in out.collect()} == {("L", 1, 2)}
    assert {r.doc_id for r in decontaminate.decontaminated(df, items, max_share=0.9).collect()} == {1, 2, 3, 5}
    assert {r.doc_id for r in decontaminate.decontaminated(df, items, max_share=0.0).collect()} == {2, 3, 5}


# -- divergence -------------------------------------------------------------

def plain_audit(rows, min_docs=3, top=200):
    """rows: (text, lang, source), by the definition, term by term."""
    rows = [[x or "" for x in r] for r in rows]
    count, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        ts = ["".join(w) for w in split_terms(text)]
        count[lang, source].update(ts)
        docs[lang].update(set(ts))
    out = set()
    groups = {(r[1], r[2]) for r in rows}
    for lang in {g[0] for g in groups}:
        kept = [t for t, d in docs[lang].items() if d >= min_docs]
        mine = sorted(s for x, s in groups if x == lang)
        whole = Counter()
        for s in mine:
            whole.update({t: count[lang, s][t] for t in kept})

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10 ** 9 * (c[t] + 1) // (total + len(kept)) for t in kept}
        p, q = {s: shares(count[lang, s]) for s in mine}, shares(whole)

        def f(a, b):
            return (a - b) ** 2 // b
        for s in mine:
            pairs = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in mine if o != s)
            out |= {(lang, s, "pair", o.decode(), -v, k) for k, (v, o) in enumerate(pairs, 1)}
            terms = sorted((-f(p[s][t], q[t]), t.encode()) for t in kept if count[lang, s][t] and p[s][t] > q[t])
            out |= {(lang, s, "term", t.decode(), -v, k) for k, (v, t) in enumerate(terms[:top], 1)}
    return out


def split_terms(text):
    word = ""
    for ch in text + " ":
        if ch > "\x7f" or ch.isalpha():
            word += ch.lower() if ch <= "\x7f" else ch
        elif word:
            yield word
            word = ""


def test_audit(spark):
    import random
    rnd = random.Random(5)
    vocab = [f"{a}{b}x" for a in "abcdeéÉ" for b in "fghijklmnop"] + ["zz", "Zz", "𝒳y"]
    rows = [(None, "en", "s1"), ("", "en", "s9"), (None, None, None), ("1 2 !", "xx", "s1"), ("", "xx", "s2"),
            ("rare words only", "yy", "a"), ("rare words", "yy", "b"), ("lonely " * 3000, "en", "s1")]
    for i in range(300):
        words = [vocab[min(int(rnd.expovariate(0.08)), len(vocab) - 1)] for _ in range(rnd.randrange(60))]
        rows.append((rnd.choice([" ", "-", "\n"]).join(words), rnd.choice(["en", "de", None]),
                     rnd.choice(["s1", "s1", "s2", "s3", None, "ü"])))
    rows += rows[-20:]  # repeated rows count each
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "text string, lang string, source string, n int, `a.b` string")
    got = [tuple(r) for r in divergence.audit(df, top_terms=20).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_audit(rows, top=20)
    assert divergence.audit(df.limit(0)).isEmpty()


def test_shares_are_exact_at_any_count(spark):
    from pyspark.sql import functions as F
    n, total, v = 3 * 10 ** 12, 9 * 10 ** 12 + 7, 12345
    row = spark.createDataFrame([(n, total, v)], "n long, total long, v long")
    got = row.select(divergence._share("n", F.col("total"), F.col("v")).alias("p")).first().p
    assert got == 1 + 10 ** 9 * (n + 1) // (total + v)
