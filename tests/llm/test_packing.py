import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from wardflow.llm import packing, queries, token_ids

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(token_ids.default_path())


@pytest.fixture(scope="module")
def chunked():
    with open(token_ids.default_path(), encoding="utf-8") as f:
        return token_ids.ChunkTokenizer(f.read())


@pytest.mark.parametrize("text", [
    None, "", " \n", "Hello, World's  don't\tyou'll", "a\x0bb\x0cc\x1cd\x85e f g　h", "<|endoftext|> x<|startoftext|>y",
    "é ́x a\ń", "ΑΣ ΑΣ. İstanbul ǅ ﬁ 漢字 😀🏽 12٣4", "x" * 5000, "ab " * 5000, "\x00 \x7f ﻿"])
def test_chunks_give_the_tokenizers_ids(tok, chunked, text):
    want = tok.encode(text or "", add_special_tokens=False).ids
    for _ in range(2):
        assert np.frombuffer(chunked.ids(text), "<u4").tolist() == want


def test_merges_give_the_tokenizers_ids(tok, chunked):
    """Random chunks of letters, vocabulary entries and any Latin character."""
    rnd = random.Random(0)
    parts = [t.replace("</w>", "") for t in tok.get_vocab()]
    chars = [chr(c) for c in range(33, 0x250) if not chr(c).isspace()]
    letters = "etaoinshrdlucmfwypvbgkjqxzéèàüößñáíó'.,"
    chunks = ["".join(rnd.choice(pool) for _ in range(rnd.randint(1, n)))
              for pool, n in ((parts, 4), (chars, 8), (letters, 25)) for _ in range(15_000)]
    want = [e.ids for e in tok.encode_batch_fast(chunks, add_special_tokens=False)]
    assert [np.frombuffer(chunked.ids(c), "<u4").tolist() for c in chunks] == want


def test_batches_give_the_same_ids(chunked, monkeypatch):
    texts = [None, "", " \n", "Hello, World's  don't\tyou'll", "a\x0bb\x0cc\x1cd\x85e f g　h", "<|endoftext|> x",
             "ΑΣ İstanbul 漢字 😀🏽 12٣4", "x" * 500, "h\u0331 H\u0331 né NÉ don't.", "ab " * 50, None]
    column = pa.array(texts * 3)
    for size in (4 << 20, 30):
        monkeypatch.setattr(token_ids, "SPLIT_BYTES", size)
        chunked.cache.clear()
        assert list(chunked.batch_ids(column.slice(4))) == [chunked.ids(t) for t in column.slice(4).to_pylist()]
    assert list(chunked.batch_ids(column.slice(0, 0))) == []


def check(rows, texts, tok, capacity):
    """Pieces give back every document's ids; sequences are gapless and fit."""
    pieces, seqs = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    want = {}
    for i, t in texts:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        want.setdefault(i, []).extend((k, s, len(ids[s:s + capacity]), zlib.crc32(ids[s:s + capacity].tobytes()))
                                      for k, s in enumerate(range(0, len(ids), capacity)))
    assert {i: sorted((r.piece, r.start, r.length, r.ids_crc32) for r in p) for i, p in pieces.items()} == {
        i: sorted(w) for i, w in want.items()}
    for places in seqs.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= capacity
    total = sum(n for p in seqs.values() for _, n in p)
    return len(seqs), -(-total // capacity)


def test_query(spark, tok):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    n, bound = check(queries.QUERIES["op8_best_fit_packing"](spark, SF).collect(), [tuple(d) for d in docs], tok, 2048)
    assert n <= 1.05 * bound + 1


def test_edges(spark, tok):
    texts = [(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (None, "d"), (4, "word " * 500), (5, "x " * 63)] + [
        (100 + i, "w " * (i % 64)) for i in range(300)]
    df = spark.createDataFrame([(i, t, 1, "p") for i, t in texts], "doc_id long, text string, length int, piece string")
    rows = packing.pack(df, capacity=64, shard_pieces=50).collect()
    n, bound = check(rows, texts, tok, 64)
    assert len({r["__row"] for r in rows}) == len(rows)
    assert n <= 1.2 * bound
    again = packing.pack(df, capacity=64, shard_pieces=50).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    assert packing.pack(df.limit(0)).isEmpty()


def test_genetic_steps():
    rnd = np.random.default_rng(3)
    lengths = rnd.integers(1, 900, 400).tolist()
    pop = packing.first_population(lengths, 1000, 4, rnd)
    first = max(p.fitness() for p in pop)
    for p in pop + [packing.crossover(pop[0], pop[1], lengths, rnd)]:
        assert sorted(i for b in p.bins for i in b) == list(range(400))
        assert p.fill == [sum(lengths[i] for i in b) for b in p.bins] and max(p.fill) <= 1000
        q = packing.Packing.from_bytes(p.to_bytes(400), lengths, 1000)
        assert sorted(map(sorted, q.bins)) == sorted(map(sorted, p.bins))
    assert packing.evolve(pop, lengths, 20, rnd)[0].fitness() >= first


def triplets(n, rnd):
    """Pieces that fill n bins of 1000 exactly, three a bin."""
    first = rnd.integers(380, 490, n)
    second = [int(rnd.integers(250, (1000 - a) // 2 + 1)) for a in first]
    return [int(x) for a, b in zip(first, second) for x in (a, b, 1000 - a - b)]


@pytest.mark.parametrize("name", ["triplets", "300-900", "500-1100"])
def test_generations_need_fewer_bins_than_best_fit(name):
    rnd = np.random.default_rng(5)
    lengths, capacity = ((triplets(300, rnd), 1000) if name == "triplets"
                         else (rnd.integers(*map(int, name.split("-")), 3000).tolist(), 2048))
    best_fit = packing.Packing(capacity)
    best_fit.best_fit(range(len(lengths)), lengths)
    first = packing.evolve(packing.first_population(lengths, capacity, 3, rnd), lengths, 0, rnd)
    found = packing.evolve(first, lengths, 12, rnd)[0]
    assert sorted(i for b in found.bins for i in b) == list(range(len(lengths)))
    assert found.fill == [sum(lengths[i] for i in b) for b in found.bins] and max(found.fill) <= capacity
    bound = packing.lower_bound(lengths, capacity)
    # at least a third of what best fit wastes is won, on triplets four fifths
    assert len(found.bins) - bound <= (0.2 if name == "triplets" else 0.67) * (len(best_fit.bins) - bound)


def test_best_fit_is_best_fit():
    p = packing.Packing(10)
    p.best_fit([0, 1, 2, 3], [6, 5, 4, 5])
    assert sorted(map(sorted, p.bins)) == [[0, 2], [1, 3]]


def test_runs_of_equal_texts():
    for texts in ([], ["a"], [None, None, "", ""], ["a", "a", "b", "a", None, "a"], ["x"] * 5):
        firsts, repeats = packing._runs(pa.array(texts, pa.string()))
        again = [texts[f] for f, n in zip(firsts.to_pylist(), repeats) for _ in range(n)]
        assert again == texts
        # slices of a batch, too
        firsts, repeats = packing._runs(pa.array(["z", *texts], pa.string()).slice(1))
        assert [texts[f] for f, n in zip(firsts.to_pylist(), repeats) for _ in range(n)] == texts


def test_copies_are_packed_each(spark):
    texts = ["a b c", "a b c", None, None, "word " * 5000, "word " * 5000, "a b c"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = packing.pack(df).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    assert len({r["__row"] for r in got}) == len(got) and set(by) == set(range(7))
    assert sorted(by[0]) == sorted(by[1]) == sorted(by[6]) and sorted(by[4]) == sorted(by[5]) and len(by[4]) == 3
    assert by[2] == by[3] == [(0, 0, 1, by[2][0][3])]
