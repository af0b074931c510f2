"""Operator 12 against the definition of a run."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from orderlens.llm import periodic_runs, queries
from orderlens.llm.byte_hash import WINDOW, hash_stretches

SF_SMALL, SF_MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
SHA = lambda s: hashlib.sha256(s.encode()).hexdigest()


def brute_runs(w, exponent=4, least=6):
    """(start, length, period): for every period the stretches that keep it, smallest period of equal stretches."""
    best = {}
    for p in range(1, len(w) // exponent + 1):
        same = np.concatenate([[False], w[:-p] == w[p:], [False]])
        edge = np.flatnonzero(same[1:] != same[:-1])
        for s, e in zip(edge[::2].tolist(), (edge[1::2] + p).tolist()):
            if e - s >= max(least, exponent * p):
                best.setdefault((s, e), p)
    return sorted(((s, e - s, p) for (s, e), p in best.items()), key=lambda r: (r[0], r[2]))


def numbers(words):
    own = {}
    return np.array([own.setdefault(x, len(own)) for x in words], np.int64)


def brute_row(doc_id, text):
    words = (text or "").replace("\x1c", "?").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [x if i < a else words[a + (i - a) % p] for i, x in enumerate(words)]
    runs = brute_runs(numbers(words))
    drop = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    return (len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            SHA("".join("%d,%d,%d\n" % r for r in runs)),
            hashlib.sha256(b" ".join(x for i, x in enumerate(words) if i not in drop)).hexdigest())


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_whole_table_against_the_definition(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in queries.op12_periodic_runs(spark, sf).collect()}
    assert len(got) == len(docs)
    assert sum(v[0] for v in got.values()) > 10
    for d in docs:
        assert got[d.doc_id] == brute_row(d.doc_id, d.text)


def test_small_alphabets_against_the_definition():
    rnd = random.Random(1)
    for _ in range(150):
        docs = []
        for _ in range(rnd.randint(1, 8)):
            n = rnd.choice([0, 1, 5, 30, 80, 200])
            w = [rnd.choice("abcdefg"[:rnd.choice([1, 2, 2, 3, 5])]) for _ in range(n)]
            if rnd.random() < .5 and n > 10:
                a = rnd.randrange(n)
                p = rnd.randint(1, max(1, (n - a) // 4))
                w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
            docs.append(w)
        texts = [rnd.choice(["", " ", "\n \t"]) + rnd.choice([" ", "\n", "\t\x0b "]).join(w) for w in docs]
        first, start, length, period, left = periodic_runs._block(list(range(len(docs))), texts, None, 4, 6)
        for i, w in enumerate(docs):
            own = slice(first[i], first[i + 1])
            want = brute_runs(numbers(w))
            assert list(zip(start[own].tolist(), length[own].tolist(), period[own].tolist())) == want
            drop = {k for s, size, q in want for k in range(s + q, s + size)}
            assert left[i] == " ".join(x for k, x in enumerate(w) if k not in drop)


@pytest.mark.parametrize("exponent, least", [(2, 2), (3, 5)])
def test_other_exponents(spark, exponent, least):
    rnd = random.Random(3)
    texts = {i: " ".join(rnd.choice("ab") for _ in range(60)) for i in range(20)}
    d = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    for r in periodic_runs.find(d, min_exponent=exponent, min_length=least).collect():
        assert [tuple(x) for x in r.runs] == brute_runs(numbers(texts[r.doc_id].split()), exponent, least)


def test_odd_rows(spark):
    long = "x " * 300_000 + "y " + "abc def " * 200_000
    rows = [(1, None, 0), (2, "", 0), (3, " \n ", 0), (4, "a a a a a a a", 0), (4, "a a a a a a a", 0),
            (None, "b " * 9, None), (5, long, 0), (6, "é " * 6 + "   ", 0)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, runs int")
    got = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.find(d).collect()), key=str)
    assert got == sorted([
        (1, [], ""), (2, [], ""), (3, [], ""), (4, [(0, 7, 1)], "a"), (4, [(0, 7, 1)], "a"), (None, [(0, 9, 1)], "b"),
        (5, [(0, 300_000, 1), (300_001, 400_000, 2)], "x y abc def"), (6, [(0, 6, 1)], "é    ")], key=str)
    assert periodic_runs.find(d.limit(0)).count() == 0


def test_hashes_do_not_depend_on_windows():
    """A stretch has the same hash wherever it lies, also across windows."""
    rnd = np.random.default_rng(4)
    word = rnd.integers(1, 255, 3 * WINDOW + 17).astype(np.uint8)
    alone = hash_stretches(word, np.array([0]))[0]
    for shift in (1, 5, WINDOW - 1, WINDOW, WINDOW + 1):
        buf = np.concatenate([np.full(shift, 7, np.uint8), word, np.full(9, 3, np.uint8)])
        h = hash_stretches(buf, np.array([0, shift, shift + len(word)]))
        assert h[1] == alone and h[0] != alone
    short = np.frombuffer(b"one two one ", np.uint8)
    h = hash_stretches(np.tile(short, WINDOW // 5), np.arange(0, len(short) * (WINDOW // 5), 4))
    assert len(set(h.tolist())) == 2
