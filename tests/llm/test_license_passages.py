import random
import textwrap

from wardflow.llm import licenses


def rows_of(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {}
    for g in sorted(licenses.license_blocks(df).collect(), key=lambda g: (g.doc_id, g.block)):
        out.setdefault(g.doc_id, []).append(g)
    return out


def prose(n, seed):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(2, 9))) for _ in range(n))


def test_closest_run_of_words():
    rnd = random.Random(2)
    for _ in range(200):
        template = [rnd.choice("abcd") for _ in range(rnd.randint(1, 6))]
        block = [rnd.choice("abcdx") for _ in range(rnd.randint(0, 8))]
        first, end, missing, extra = licenses.align(block, template)
        assert end - first - len(extra) == len(template) - len(missing)

        def common(a, b):
            if not a or not b:
                return 0
            return max(common(a[1:], b), common(a, b[1:]), (a[0] == b[0]) + common(a[1:], b[1:]) if a[0] == b[0] else 0)
        best = min(len(template) + (hi - lo) - 2 * common(block[lo:hi], template)
                   for lo in range(len(block) + 1) for hi in range(lo, len(block) + 1))
        assert len(missing) + len(extra) == best


def test_notice_inside_a_long_line(spark):
    """Each exact notice within a line of 50,000 words."""
    head, tail = prose(25_000, 1), prose(25_000, 2)
    got = rows_of(spark, [f"{head} {t} {tail}" for t in licenses.TEMPLATES.values()])
    for k, (name, t) in enumerate(licenses.TEMPLATES.items()):
        assert [(g.license, g.start, g.end) for g in got[k]] == [(name, len(head) + 1, len(head) + 1 + len(t))]
        assert got[k][0].reduction > 0


def test_notices_far_apart_in_a_long_line(spark):
    t = licenses.TEMPLATES
    got = rows_of(spark, [f"{prose(5000, 1)} {t['MIT']} {prose(5000, 2)} {t['GPL-2.0']} {prose(5000, 3)}"])
    assert [g.license for g in got[0]] == ["MIT", "GPL-2.0"]


def test_every_notice_of_a_block(spark):
    t = licenses.TEMPLATES
    dual = "Licensed under the Apache License, Version 2.0.\nReleased under the MIT License."
    many = " or ".join([*t.values(), *t.values()])
    close = t["Apache-2.0"] + " " + t["Apache-2.0-header"] + " " + t["MIT-notice"].replace("hereby ", "") + t["MIT"]
    texts = [dual, many, close, (t["MIT"] + " ") * 3000]
    got = rows_of(spark, texts)
    assert [(g.license, texts[0][g.start:g.end]) for g in got[0]] == [("Apache-2.0", t["Apache-2.0"]), ("MIT", t["MIT"])]
    assert [(g.license, texts[1][g.start:g.end]) for g in got[1]] == [*t.items(), *t.items()]
    assert [g.license for g in got[2]] == ["Apache-2.0", "Apache-2.0-header", "MIT-notice", "MIT"]
    assert [g.license for g in got[3]] == ["MIT"] * 3000 and [g.block for g in got[3]] == list(range(3000))


def test_wrapped_notices(spark):
    t, texts, want = licenses.TEMPLATES, [], []
    for name in ("MIT-notice", "Apache-2.0-header", "GPL-3.0"):
        for width in (12, 40, 72):
            for gap in ("\n", "\n\n", "\n# "):
                notice = textwrap.fill(t[name], width, break_long_words=False, break_on_hyphens=False).replace("\n", gap)
                texts.append("Title\n\n" + notice + "\n\nSome words follow.\n")
                want.append([(name, notice)])
    texts.append("Copyright 2020 Somebody\n\n" + textwrap.fill(t["MIT-notice"], 72) + "\n\nThe above copyright notice\n\nx")
    want.append([(None, "Copyright 2020 Somebody"), ("MIT-notice", textwrap.fill(t["MIT-notice"], 72)),
                 (None, "The above copyright notice")])
    got = rows_of(spark, texts)
    for k, w in enumerate(want):
        assert [(g.license, texts[k][g.start:g.end].rstrip()) for g in got[k]] == w


def wording_search(scanner, text):
    """Brute force: (start, end, name) of every run of words that is some
    template's wording but for the words that may differ; of those that
    overlap the longest, then the one with the fewest differences."""
    spans = [m.span() for m in licenses.WORD.finditer(text)]
    own, found = [text[a:b].lower() for a, b in spans], []
    for name, words in scanner.words.items():
        k = scanner.may_differ[name]
        starts = range(len(own)) if k else [i for i in range(len(own)) if own[i:i + len(words)] == words]
        for i in starts:
            if k and len({*own[i:i + len(words)]} & {*words}) < 0.8 * len({*words}):
                continue
            first, end, missing, extra = licenses.align(own[i:i + len(words) + k], words)
            if len(missing) + len(extra) <= k and not scanner.naming & {*missing, *extra}:
                found.append((first - end, len(missing) + len(extra), i + first, i + end, name))
    taken, out = set(), set()
    for _, _, a, b, name in sorted(found):
        if taken.isdisjoint(range(a, b)):
            taken.update(range(a, b))
            out.add((spans[a][0], spans[b - 1][1], name))
    return out


def planted(seed):
    rnd = random.Random(seed)
    parts = []
    for _ in range(rnd.randint(1, 4)):
        name = rnd.choice(list(licenses.TEMPLATES))
        words = licenses.TEMPLATES[name].split(" ")
        for _ in range(int(0.03 * len(words)) if rnd.random() < 0.5 else 0):
            words.pop(rnd.randrange(5, len(words) - 5))
        notice = " ".join(words)
        if rnd.random() < 0.5:
            notice = textwrap.fill(notice, rnd.choice([12, 40, 72])).replace("\n", rnd.choice(["\n", "\n# "]))
        parts += [prose(rnd.choice([0, 3, 200]), rnd.random()), notice]
    return " ".join(parts)


def test_recall_against_the_wording_search():
    """Every notice of 60 planted texts, wrapped, changed and in one line."""
    scanner = licenses.Scanner(licenses.TEMPLATES)
    n = 0
    for seed in range(60):
        text = planted(seed)
        want = wording_search(scanner, text)
        got = {(lo, name) for lo, hi, name, *_ in scanner.blocks(text) if name}
        assert got == {(lo, name) for lo, hi, name in want}, seed
        n += len(want)
    assert n > 100


def test_the_ranking_decides():
    """With savings dealt out to other templates, and with candidates in
    another order, other rows come out."""
    rnd = random.Random(4)

    class Shuffled(licenses.Scanner):
        def saved(self, name, words):
            if not hasattr(self, "own_saving"):
                return super().saved(name, words)
            return super().saved(rnd.choice(list(self.words)), words)

    class Backwards(licenses.Scanner):
        def ranked(self, savings):
            return super().ranked(savings)[::-1]

    right = licenses.Scanner(licenses.TEMPLATES)
    names = list(licenses.TEMPLATES)
    texts = [f"{prose(40, k)} {licenses.TEMPLATES[n]} {prose(40, -k - 1)}" for k, n in enumerate(names)]
    want = [[r[2] for r in right.blocks(t)] for t in texts]
    assert want == [[n] for n in names]
    assert sum([r[2] for r in Shuffled(licenses.TEMPLATES).blocks(t)] != w for t, w in zip(texts, want)) > len(names) // 3
    back = Backwards(licenses.TEMPLATES)
    assert [r[2] for r in back.blocks(texts[names.index("Apache-2.0-header")])][0] == "Apache-2.0"


def test_text_dense_in_license_words():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    text = "license " * 20_000
    assert [(r[0], r[2]) for r in scanner.blocks(text)] == [(0, None)]


def test_short_notice_between_words_that_save_little():
    text = "Released under the MIT License. athahe tint ertioninghe ofndheou " + prose(50, 9)
    assert [r[2] for r in licenses.Scanner(licenses.TEMPLATES).blocks(text)] == ["MIT"]
