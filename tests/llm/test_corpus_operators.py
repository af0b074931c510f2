"""Each operator against a brute-force version, a round trip or held-out accuracy."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import Row

from orderlens.llm import (byte_bpe, decontaminate, language_id, line_dedup, near_dups, quality_rules, queries,
                           secret_scan, sharding, token_files, toxicity)
from orderlens.llm.components import connected_components

SF_SMALL, SF_MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
SF_LARGE = "/root/testdata/sf0.1"           # a few hundred labels (sf0.01) are too few to learn from
SHA = lambda b: hashlib.sha256(b).hexdigest()


def rows_of(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and an extra column with a clashing name."""
    rows = [(1, None, None, "x"), (2, "", "en", "x"), (3, " \n\t ", "en", "x"), (4, "word " * 60, "en", "y"),
            (4, "word " * 60, "en", "y"), (5, "Ünïcode ñandú 日本語 \U0001F600 é don't 12.5\n\n  x", "es", None),
            (None, "no id but some words in here to count", "en", "z"), (6, "a", None, "z"),
            (7, "long " + "abc defg hij " * 20000, "en", "z")]
    return spark.createDataFrame(
        [Row(doc_id=a, text=b, lang=c, n_tokens=d) for a, b, c, d in rows],
        "doc_id bigint, text string, lang string, n_tokens string")


# ---- 1 byte-level BPE

def tiktoken_model():
    import base64
    import public_tokenizers as P
    import tiktoken
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_against_the_rank_library(spark, texts):
    enc = tiktoken_model()
    got = rows_of(queries.op1_byte_bpe(spark, SF_SMALL))
    assert len(got) == len(texts)
    for i, t in texts.items():
        ids = enc.encode_ordinary(t or "")
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (
            len(ids), SHA(" ".join(map(str, ids)).encode()), SHA((t or "").encode()))


def test_byte_bpe_odd_texts_offsets_and_decoding(spark, odd):
    enc = tiktoken_model()
    encoded = byte_bpe.encode(odd)
    rows = encoded.collect()
    want = sorted((enc.encode_ordinary(r.text or "") for r in odd.collect()), key=str)
    assert sorted((r.ids for r in rows), key=str) == want
    assert sorted((r.text for r in byte_bpe.decode(encoded).collect())) == sorted(r.text or "" for r in odd.collect())
    t = next(r.text for r in odd.collect() if r.doc_id == 5)
    r = next(r for r in rows if r.doc_id == 5)
    raw = t.encode()
    for k, (b, c) in enumerate(zip(r.byte_start, r.char_start)):
        assert len(raw[:b].decode("utf-8", "ignore")) in (c, c + 0)
    assert r.byte_start[0] == 0 and r.char_start == sorted(r.char_start)
    assert byte_bpe.round_trip(odd.limit(0)).count() == 0


def test_byte_bpe_long_texts_in_parts(spark, monkeypatch):
    """Texts beyond one part and one digest, with few places to cut: the same ids."""
    import random

    from orderlens.llm import piece_cache
    rnd = random.Random(2)
    enc = tiktoken_model()
    words = ["the", "don't", "x1", "Ünï", "\n", "\n\n", "  ", "12345", "...", "a.b", "😀", "日本"]
    texts = {i: "".join(rnd.choice(words) + rnd.choice([" ", " ", "", "\n"]) for _ in range(2000)) for i in range(6)}
    texts |= {10: "abc" * 3000, 11: " . " * 3000, 12: "", 13: "a " * 4000}
    d = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").coalesce(1)
    want = {i: (len(x), SHA(" ".join(map(str, x)).encode()), SHA(texts[i].encode()))
            for i, x in ((i, enc.encode_ordinary(t)) for i, t in texts.items())}
    assert {r.doc_id: tuple(r)[1:4] for r in byte_bpe.round_trip(d).collect()} == want
    monkeypatch.setattr(piece_cache, "PART_BYTES", 500)
    monkeypatch.setattr(byte_bpe, "DIGEST_IDS", 100)
    m = byte_bpe.ByteBpe(byte_bpe._vocabulary(None))
    ids, at = m.encode(list(texts.values()))
    for s, e, t in zip(at, at[1:], texts.values()):
        own = ids[s:e]
        assert own.tolist() == enc.encode_ordinary(t)
        assert byte_bpe._digests(m, own)[:2] == (SHA(" ".join(map(str, own.tolist())).encode()), SHA(t.encode()))
    parts = piece_cache.short_parts(b"ab cd  ef gh" * 50, 20)
    assert b"".join(parts) == b"ab cd  ef gh" * 50 and all(p[:1] == b" " for p in parts[1:])


@pytest.mark.parametrize("work", ["byte_bpe", "token_files", "near_dups", "toxicity", "periodic_runs"])
def test_memory_of_a_very_long_text(work):
    """A text of 64 MB in a fresh process: what the worker holds beside it is bounded, and little of it stays."""
    import subprocess
    import sys
    code = f"""
import resource, sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))!r})
import numpy as np
from orderlens.llm import byte_bpe, token_files, near_dups, toxicity, periodic_runs
from orderlens.llm.common import give_back
rnd = np.random.default_rng(1)
words = np.array(["w%d" % i for i in range(5000)])
draw = lambda: " ".join(words[rnd.integers(0, 5000, 400_000)])
text = " ".join([draw() for _ in range(30)]) + " x" * 1000
assert len(text) >= 64_000_000
def rss():
    return int(open("/proc/self/statm").read().split()[1]) * 4096 / 1e6
before = rss()
if {work!r} == "byte_bpe":
    m = byte_bpe.ByteBpe(byte_bpe._vocabulary(None)); ids, at = m.encode([text]); byte_bpe._digests(m, ids); del ids, at
elif {work!r} == "token_files":
    import public_tokenizers
    ids, at = token_files.cache_of(public_tokenizers.path(token_files.VOCABULARY)).encode([text]); del ids, at
elif {work!r} == "near_dups":
    h, at = near_dups.word_hashes([text]); s = near_dups.shingle_set(h); near_dups.signature(s); del h, at, s
elif {work!r} == "toxicity":
    h, at = toxicity.word_hashes([text]); f = toxicity.features(h); del h, at, f
else:
    out = periodic_runs._block([1], [text], None, 4, 6); assert (out[2].tolist(), out[3].tolist()) == ([1000], [1]); del out
give_back()
after = rss()
peak = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1e3
print(before, after - before, peak - before)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    before, left, peak = map(float, out.stdout.split())
    print(work, before, left, peak)
    assert left < 250, (work, before, left, peak)
    assert peak < (2600 if work == "periodic_runs" else 1300), (work, before, left, peak)


# ---- 2 decontamination

def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute_contamination(docs, items, window=10):
    wins = {}
    for item, t in items:
        w = words(t)
        for p in range(max(len(w) - window, 0) + 1 if w else 0):
            wins.setdefault(tuple(w[p:p + window]), set()).add(str(item))
    out = {}
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in wins}:
            for p in range(len(w) - n + 1):
                if tuple(w[p:p + n]) in wins:
                    hit |= set(range(p, p + n))
                    found |= wins[tuple(w[p:p + n])]
        out[i] = (len(w), len(hit), len(found), SHA(",".join(sorted(found)).encode()), bool(hit))
    return out


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_WINDOWS, 0])
def test_decontamination_both_join_forms(spark, limit):
    base = "one two three four five six seven eight nine ten eleven twelve"
    items = [("a", base), ("b", "short item"), ("c", None), ("d", base), ("e", "the the the the the the the the the the the"),
             ("f", "x")]
    docs = [(1, "zero " + base.upper() + " end"), (2, "a short, item; short item"), (3, None), (4, "nothing here"),
            (5, "the " * 30), (6, base.replace("six", "sechs")), (7, "x"), (8, "")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    b = spark.createDataFrame(items, "item_id string, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
           for r in decontaminate.report(d, b, broadcast_windows=limit).collect()}
    assert got == brute_contamination(docs, items)
    left = {r.doc_id for r in decontaminate.clean(d, b, broadcast_windows=limit).collect()}
    assert left == {i for i, v in got.items() if not v[4]}
    assert decontaminate.report(d, b.limit(0)).filter("contaminated").count() == 0
    assert decontaminate.report(d.limit(0), b).count() == 0


def test_decontamination_oracle(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = queries.op2_decontaminate(spark, SF_SMALL)
    rel = con.sql(decontaminate.ORACLE_SQL)
    assert sorted(df.columns) == sorted(rel.columns)
    assert sorted(map(tuple, df.select(*rel.columns).collect())) == sorted(rel.fetchall())


def test_decontamination_repeated_rows(spark, odd):
    b = spark.createDataFrame([("i", "word " * 12)], "item_id string, text string")
    got = decontaminate.report(odd, b)
    assert got.count() == odd.count() and got.filter("contaminated").count() == 2


# ---- 3 secrets

def brute_base(t):
    out = []
    for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t):
        if len(m[2]) >= 6:
            out.append(("assign", *m.span()))
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return out


def test_secret_base_spans(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    got = rows_of(queries.op3_secret_scan(spark, SF_MID))
    kinds = Counter()
    for i, t in texts.items():
        want = brute_base(t or "")
        n = Counter(k for k, _, _ in want)
        kinds += n
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == (n["assign"], n["access"], n["hex"])
        assert got[i].base_sha256 == SHA(secret_scan.joined(want).encode())
        spans = set(filter(None, got[i].spans.split(",")))
        assert {f"{k}:{a}:{b}" for k, a, b in want} <= spans
    assert sum(kinds.values()) > 0


def test_entropy_windows_against_brute_force():
    import random
    rnd = random.Random(3)
    for _ in range(60):
        s = "".join(rnd.choice("abcdefABCDEF0123456789+/xyzXYZ") for _ in range(rnd.randint(20, 90)))
        marked = set()
        for p in range(len(s) - 19):
            w = s[p:p + 20]
            h = -sum(c / 20 * math.log2(c / 20) for c in Counter(w).values())
            if h >= 3.7 + 1e-9 and any(x.isdigit() for x in w) and any(x.isalpha() for x in w):
                marked |= set(range(p, p + 20))
        got = {i for a, b in secret_scan.entropy_runs(s, 3.7 + 1e-9) for i in range(a, b)}
        assert got == marked


def test_secret_cases(spark, odd):
    token = "gH7kP2xQ9vL4mT8wZ3nB6yC1"
    t = f"see {token} and EXAMPLE{token} é Password = 'hunter2x' ſecret: abcdefg token: abc"
    d = spark.createDataFrame([(1, t)], "doc_id bigint, text string")
    r = secret_scan.scan(d).first()
    at = t.index(token)
    assert f"entropy_base64:{at}:{at + len(token)}" in r.spans.split(",")
    assert r.n_entropy == 1 and r.n_assign == 1          # allow-list; the long s is no letter of the pattern
    assert secret_scan.scan(odd).count() == odd.count() and secret_scan.scan(odd.limit(0)).count() == 0


def test_secret_beside_an_allowed_word():
    allow = [re.compile(a) for a in secret_scan.ALLOW]
    token = "gH7kP2xQ9vL4mT8wZ3nB6yC1rF5sD0jK8uE2aXq7"
    cut = "gH7kP2xQ9vL4/mT8wZ3nB6yC1/x/rF5sD0jK8uE2aXq7"
    for before, secret in (("EXAMPLE_KEY=", token), ("/example/", token), ("lorem/", cut), ("", token), ("", cut)):
        for after in ("", "/dummy/file"):
            t = f"see {before}{secret}{after} here"
            spans = secret_scan.entropy_spans(t, allow)
            at = t.index(secret)
            assert [(k, a) for k, a, _ in spans] == [("entropy_base64", at)]
            assert at + len(secret) <= spans[0][2] <= at + len(secret) + 1
    for t in (f"EXAMPLE{token}", f"/home/your_key{token}/file", f"key=dummy-{token}"):
        assert secret_scan.entropy_spans(t, allow) == []


# ---- 4 token files

def brute_ids(texts):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    m = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    m.encode_special_tokens = True
    return [m.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]


def test_token_files_round_trip(spark, texts):
    got = rows_of(queries.op4_token_files(spark, SF_SMALL))
    start = 0
    for i, ids in zip(sorted(texts), brute_ids([texts[i] for i in sorted(texts)])):
        crc = zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids))
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), crc)
        start += len(ids)


def test_token_files_odd_rows_and_single_document(spark, odd, tmp_path):
    files = token_files.write(odd, f"file:{tmp_path}/tokens")
    rows = sorted(token_files.read(spark, files).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 4, 4, 5, 6, 7]
    want = {r.doc_id: brute_ids([r.text])[0] for r in odd.collect()}
    at = 0
    for r in rows:
        assert r.ids == want[r.doc_id] and r.start == at
        at += r.n_tokens
    assert token_files.read_document(spark, files, 5) == want[5]
    assert token_files.read_document(spark, files, 99) is None
    empty = token_files.write(odd.limit(0), f"file:{tmp_path}/none")
    assert token_files.read(spark, empty).count() == 0


# ---- 5 near-duplicates

def shingles(t):
    w = [x for x in re.split("[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 5, 0) + 1)} if w else set()


def brute_components(texts, percent=85):
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_near_dups_against_all_pairs(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = rows_of(queries.op5_near_dups(spark, sf))
    want = brute_components(texts)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


@pytest.mark.parametrize("name", ["op5_near_dups", "op8_line_dedup"])
def test_oracles_of_groups_and_lines(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    df = queries.QUERIES[name](spark, SF_SMALL)
    rel = con.sql(queries.ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert sorted(map(str, map(tuple, df.select(*rel.columns).collect()))) == sorted(map(str, rel.fetchall()))


def test_near_dups_chain_of_groups(spark):
    """Two stars joined only through members that are not leaders."""
    import random
    rnd = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    texts, now = {}, list(base)
    for i in range(60):
        texts[(i * 37) % 61] = " ".join(now)
        now = list(now)
        now[rnd.randrange(200)] = f"n{i}"
        now[rnd.randrange(200)] = f"m{i}"
    d = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dups.groups(d).collect()}
    assert got == brute_components(texts)


def test_near_dups_stage_against_all_pairs_at_80(spark):
    """Pairs on both sides of 0.80 and of 0.85; the stage keeps the first of each group."""
    import random

    import corpus_pipeline as C
    assert near_dups.banding(85) == (36, 8) and near_dups.least_equal(85) == 457
    bands, size = near_dups.banding(80)
    assert (1 - 0.8 ** size) ** bands < 1.2e-5 and bands * size <= near_dups.MINIMA
    rnd, texts = random.Random(4), {}
    for i in range(150):
        words = [f"d{i}w{k}" for k in range(200)]
        texts[2 * i] = " ".join(words)
        # one word in the middle takes 5 of 196 shingles: similarity 0.90 to 0.73
        for k in range(rnd.randint(2, 6)):
            words[10 + 30 * k] = f"x{k}"
        texts[2 * i + 1] = " ".join(words)
    want = {i for i, (_, root) in brute_components(texts, 80).items() if i == root}
    assert want < {i for i, (_, root) in brute_components(texts, 85).items() if i == root}
    d = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert {r.doc_id for r in C.near_dup_stage(spark, d, SF_SMALL).collect()} == want


def test_near_dups_odd_rows(spark, odd):
    got = near_dups.groups(odd).collect()
    assert len(got) == odd.count()
    by = {r.doc_id: r for r in got}
    assert (by[4].n_shingles, by[4].component_id) == (1, 4) and by[1].n_shingles == 0 and by[1].kept
    left = near_dups.keep_one(odd)
    assert left.columns == odd.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(["1", "2", "3", "4", "5", "6", "7", "None"])
    assert near_dups.groups(odd.limit(0)).count() == 0 and near_dups.keep_one(odd.limit(0)).count() == 0


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 90), (95, 90), (95, 101), (7, 7)]
    df = connected_components(spark.createDataFrame(edges, "u bigint, v bigint"))
    got = {r.node: r.root for r in df.collect()}
    assert got == {i: 1 for i in range(1, 41)} | {i: 90 for i in (90, 95, 100, 101)}


# ---- 6 sharding

def test_sharding(spark, docs, odd):
    got = queries.op6_sharding(spark, SF_SMALL).collect()
    raw = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    assert {r.doc_id: (r.size, r.text_crc32) for r in got} == {i: (len(b) + 1, zlib.crc32(b)) for i, b in raw.items()}
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert all(r.grown_shard in (r.shard, 8) and 0 <= r.shard < 8 and r.law == "key" for r in got)
    assert any(r.grown_shard == 8 for r in got)
    again = {r.doc_id: r.shard for r in sharding.assign(docs.repartition(5), shards=9).collect()}
    assert again == {r.doc_id: r.grown_shard for r in got}
    rows = sharding.assign(odd, bins=2).collect()
    assert len(rows) == odd.count() and len({(r.shard, r.slot) for r in rows}) == len(rows)
    assert sharding.assign(odd.limit(0)).count() == 0


def test_sharding_weights(spark):
    d = spark.range(20000).selectExpr("id as doc_id", "cast(id as string) as text")
    n = Counter(r.shard for r in sharding.assign(d, weights=[1, 2, 1]).collect())
    assert abs(n[1] / 20000 - 0.5) < 0.02 and abs(n[0] - n[2]) < 600


# ---- 7 language

def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    got = rows_of(queries.op7_language_id(spark, SF_MID))
    truth = {r.doc_id: (r.lang, r.text) for r in docs.collect()}
    held = [i for i, r in got.items() if r.held_out]
    assert {i for i in got if zlib.crc32(str(i).encode()) % 4 == 2} == set(held)
    right = sum(got[i].lang_pred == truth[i][0] for i in held)
    assert right >= 0.95 * len(held)
    assert sum(r.rejected for r in got.values()) <= 0.02 * len(got)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_cases(spark, odd):
    p = language_id.fit(odd)
    got = language_id.predict(odd, p).collect()
    assert len(got) == odd.count()
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3)} == {"und"}
    assert {r.lang_pred for r in got} <= {"und", *p.languages}
    none = language_id.predict(odd, language_id.fit(odd.limit(0)))
    assert {r.lang_pred for r in none.collect()} == {"und"}
    assert language_id.keep_identified(odd, p).columns == odd.columns


def test_language_rejects_noise_mixtures_and_unlearned_languages(spark):
    import random
    rnd = random.Random(3)
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    rows = [r for r in docs.select("doc_id", "lang", "text").collect() if len(r.text or "") >= 1500]
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    profile = language_id.fit(docs)
    own = language_id._compressors(profile)
    rejected = lambda t: language_id.classify(t, profile, own)[2]
    for n in (70, 150, 400, 1500):
        noise = [" ".join("".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=rnd.randint(2, 9))) for _ in range(n))[:n]
                 for _ in range(40)]
        assert sum(map(rejected, noise)) >= 38
        clean = [r.text[:n] for r in held]
        assert sum(map(rejected, clean)) <= 0.03 * len(clean)
    mixed = [a.text[:750] + " " + b.text[:750] for a in held for b in held if a.lang < b.lang]
    assert sum(map(rejected, mixed)) >= 0.33 * len(mixed)
    profile = language_id.fit(docs.filter("lang <> 'de'"))
    own = language_id._compressors(profile)
    for n in (100, 400, 1500):
        unlearned = [r.text[:n] for r in rows if r.lang == "de"]
        assert sum(map(rejected, unlearned)) >= 0.85 * len(unlearned)


def test_language_against_plain_classification(spark):
    """Every text, language and piece in plain loops, with the fitted dictionaries and limits."""
    import zstandard
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    profile = language_id.fit(docs)
    got = rows_of(language_id.predict(docs, profile))
    coders = []
    for content in profile.contents:
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        coders.append(zstandard.ZstdCompressor(dict_data=d, level=6, write_content_size=False, write_checksum=False,
                                               write_dict_id=False))
    for r in docs.collect():
        words, now = [], ""
        for c in (r.text or "").lower() + " ":
            if c.isalpha():
                now += c
            elif now:
                words.append(now)
                now = ""
        raw = " ".join(words).encode()
        g = got[r.doc_id]
        if not raw:
            assert (g.lang_pred, g.score, g.rejected) == ("und", 0.0, True)
            continue
        size = [sum(len(c.compress(raw[i:i + 2048])) for i in range(0, len(raw), 2048)) for c in coders]
        best = min(range(len(size)), key=lambda k: (size[k], k))
        margin = min(x for k, x in enumerate(size) if k != best) / size[best] - 1
        rejected = False
        sizes = [x[0] for x in profile.limits[best]]
        if len(raw) >= sizes[0]:
            at = [math.log(x) for x in sizes]
            least, most = (np.interp(math.log(len(raw)), at, [x[k] for x in profile.limits[best]]) for k in (1, 2))
            assert min(abs(margin - least), abs(size[best] / len(raw) - most)) > 1e-9
            rejected = margin < least or size[best] / len(raw) > most
        assert (g.lang_pred, g.rejected) == (profile.languages[best], rejected)
        assert abs(g.score - min(1, margin)) < 1e-12


def test_language_letters_ties_and_few_samples(spark):
    p = language_id.Profile(("aa", "bb"), (b"abc abd abe " * 9, b"abc abd abe " * 9))
    asked = spark.createDataFrame([(1, "\u00b2 \u00bd \u2467 12 _"), (2, "abc abd"), (3, "\u65e5\u672c")], "doc_id bigint, text string")
    got = rows_of(language_id.predict(asked, p))
    assert (got[1].lang_pred, got[1].rejected) == ("und", True)        # numbers are no letters
    assert (got[2].lang_pred, got[2].score) == ("aa", 0.0)             # a tie: the first language
    assert got[3].lang_pred == "aa"
    assert language_id.predict(asked.limit(0), p).count() == 0
    # a language with a few notes takes the limits of the others
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text", "lang")
    few = docs.unionByName(spark.createDataFrame([(i, "qqq www zzz " * 9, "zz") for i in (-1, -2, -3, -4)], docs.schema))
    p = language_id.fit(few)
    zz, others = p.limits[p.languages.index("zz")], [x for k, x in enumerate(p.limits) if p.languages[k] != "zz"]
    assert zz and all(least == min(y[1] for x in others for y in x if y[0] == n) for n, least, _ in zz)


def test_language_of_long_or_tiny_texts_is_learned(spark):
    """One language has books only, one a short note beside them, one a single letter."""
    import random

    from pyspark.sql import functions as F
    rnd = random.Random(9)
    words = {c: ["".join(rnd.choice(letters) for _ in range(rnd.randint(3, 8))) for _ in range(300)]
             for c, letters in (("aa", "abcdefgh"), ("bb", "ijklmnop"), ("cc", "qrstuvw"))}
    text = lambda c, n: " ".join(rnd.choice(words[c]) for _ in range(n))
    rows = [(1, "aa", text("aa", 40000)), (2, "bb", text("bb", 30)), (3, "bb", "qqqq"), (4, "bb", text("bb", 40000)),
            (5, "zz", "z")] + [(10 + i, "cc", text("cc", 60)) for i in range(20)]
    d = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    p = language_id.fit(d, learn=F.lit(True))
    size = dict(zip(p.languages, map(len, p.contents)))
    assert set(size) == {"aa", "bb", "cc", "zz"} and 8 <= size["zz"] < 20
    assert size["aa"] > 100_000 and size["bb"] > 100_000
    asked = spark.createDataFrame([(1, text("aa", 60)), (2, text("bb", 60)), (3, text("cc", 60))], "doc_id bigint, text string")
    assert [r.lang_pred for r in language_id.predict(asked, p).orderBy("doc_id").collect()] == ["aa", "bb", "cc"]


# ---- 8 line runs

def defined_lines(texts, least=50):
    """From the definition: every earlier place of the same line, each pair's longest agreement."""
    seq = [(i, k, x, len(re.split("[\x20\x09-\x0D]+", x.strip(" \t\n\x0b\x0c\r")))) for i in sorted(texts)
           for k, x in enumerate((texts[i] or "").split("\n")) if x.strip(" \t\n\x0b\x0c\r")]
    gone, places = {i: set() for i in texts}, {}
    for p in range(len(seq)):
        longest = 0
        for q in places.get(seq[p][2], ()):
            m = 0
            while (p + m < len(seq) and seq[p + m][2] == seq[q + m][2] and seq[p + m][0] == seq[p][0]
                   and seq[q + m][0] == seq[q][0]):
                m += 1
            longest = max(longest, m)
        places.setdefault(seq[p][2], []).append(p)
        if sum(x[3] for x in seq[p:p + longest]) >= least:
            gone[seq[p][0]] |= {x[1] for x in seq[p:p + longest]}
    return gone


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_line_runs_against_brute_force(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    want = defined_lines(texts)
    got = rows_of(queries.op8_line_dedup(spark, sf))
    assert sum(map(len, want.values())) > 0
    for i, t in texts.items():
        assert {int(x) for x in got[i].deleted_lines.split(",") if x} == want[i]
        assert got[i].text == "\n".join(x for k, x in enumerate(t.split("\n")) if k not in want[i])


def test_line_runs_small_lines(spark, odd):
    """Runs of several short lines, maximal to the right, with blank lines between and overlaps."""
    import random
    rnd = random.Random(2)
    lines = [" ".join(f"{c}{k}" for k in range(n)) for c, n in zip("abcdefgh", (3, 9, 14, 2, 30, 7, 55, 1))]
    texts = {i: "\n".join(rnd.choice(lines + [""]) if rnd.random() < .9 else f"own{rnd.random()}"
                          for _ in range(rnd.randint(0, 40))) for i in range(60)}
    d = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = rows_of(line_dedup.report(d))
    want = defined_lines(texts)
    assert {i: {int(x) for x in r.deleted_lines.split(",") if x} for i, r in got.items()} == want
    rep = line_dedup.report(odd)
    assert rep.count() == odd.count() and line_dedup.report(odd.limit(0)).count() == 0
    assert line_dedup.clean(odd).columns == odd.columns
    assert {r.doc_id: r.text for r in line_dedup.clean(d).collect()} == {i: r.text for i, r in got.items()}


def test_line_runs_longest_agreement_with_any_earlier_place(spark):
    import random
    rnd = random.Random(8)
    block = " ".join(f"p{k}" for k in range(60))
    x, y = (" ".join(f"{c}{k}" for k in range(10)) for c in "xy")
    case = {1: f"{block}\n{x}", 2: f"{block}\n{y}", 3: f"{block}\n{y}"}
    assert defined_lines(case) == {1: set(), 2: {0}, 3: {0, 1}}
    lines = [" ".join(f"{c}{k}" for k in range(n)) for c, n in zip("abcdef", (3, 9, 14, 30, 55, 1))]
    mixed = {10 + i: "\n".join(rnd.choice([*lines, ""]) if rnd.random() < .95 else f"own{rnd.random()}"
                               for _ in range(rnd.randint(0, 30))) for i in range(40)}
    rnd = random.Random(2)                    # the texts of test_line_runs_small_lines
    small = [" ".join(f"{c}{k}" for k in range(n)) for c, n in zip("abcdefgh", (3, 9, 14, 2, 30, 7, 55, 1))]
    short = {i: "\n".join(rnd.choice(small + [""]) if rnd.random() < .9 else f"own{rnd.random()}"
                          for _ in range(rnd.randint(0, 40))) for i in range(60)}
    for texts in (case, mixed, short):
        d = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
        got = {i: {int(k) for k in r.deleted_lines.split(",") if k} for i, r in rows_of(line_dedup.report(d)).items()}
        assert got == defined_lines(texts)


def test_line_runs_nested_and_tied(spark):
    """Runs inside runs, whole documents of one line, copies that overlap."""
    import random
    rnd = random.Random(5)
    lines = [" ".join(f"{c}{k}" for k in range(n)) for c, n in zip("abc", (20, 30, 40))]
    texts = {i: "\n".join(rnd.choice(lines) for _ in range(rnd.randint(0, 12))) for i in range(40)}
    texts |= {50 + i: "\n".join([lines[0]] * (9 - i)) for i in range(4)}
    d = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r.doc_id: set(r.gone) for r in line_dedup.deletions(d).collect()}
    assert got == {i: g for i, g in defined_lines(texts).items() if g}


# ---- 9 toxicity

def test_toxicity_held_out(spark):
    got = rows_of(queries.op9_toxicity(spark, SF_LARGE))
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_LARGE}/labels.parquet").collect()}
    held = [i for i in labels if got[i].held_out]
    assert {i for i in got if zlib.crc32(str(i).encode()) % 4 == 2} == {i for i in got if got[i].held_out}
    toxic, clean = [i for i in held if labels[i]], [i for i in held if not labels[i]]
    assert sum(got[i].predicted for i in toxic) >= 0.8 * len(toxic)
    assert sum(got[i].predicted for i in clean) <= 0.05 * len(clean)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())


def test_toxicity_cases(spark, odd):
    labels = spark.createDataFrame([(4, 1), (5, 0), (7, 0), (6, None), (6, 3)], "doc_id bigint, toxic int")
    w = toxicity.fit(odd, labels)
    assert toxicity.score(odd, w).count() == odd.count()
    one = toxicity.fit(odd, labels.filter("toxic = 0"))
    assert not len(one.place) and toxicity.score(odd, one).filter("predicted = 1").count() == 0


def plain_ftrl(rows, l1, shards, rounds):
    """FTRL-proximal over dicts: (shard, places, label) rows in order, states averaged where a shard met them."""
    a, b, l2 = toxicity.ALPHA, toxicity.BETA, toxicity.L2
    pos = sum(y for _, _, y in rows)
    prior = (pos + 0.1) / (len(rows) + 1.0)
    z, n = {"bias": -math.log(prior / (1 - prior)) * ((b + 1) / a + l2)}, {"bias": 1.0}

    def weight(x, z, n):
        if x != "bias" and abs(z.get(x, 0.0)) <= l1:
            return 0.0
        zx = z.get(x, 0.0)
        return -(zx - (0 if x == "bias" else math.copysign(l1, zx))) / ((b + math.sqrt(n.get(x, 0.0))) / a + l2)
    for _ in range(rounds):
        after = []
        for s in range(shards):
            zs, ns, met = dict(z), dict(n), set()
            for k, places, y in rows:
                if k != s:
                    continue
                w = {x: weight(x, zs, ns) for x in [*places, "bias"]}
                g = 1 / (1 + math.exp(-max(min(sum(w.values()), 35), -35))) - y
                for x, v in w.items():
                    square = ns.get(x, 0.0) + g * g
                    zs[x] = zs.get(x, 0.0) + g - (math.sqrt(square) - math.sqrt(ns.get(x, 0.0))) / a * v
                    ns[x] = square
                    met.add(x)
            after.append((zs, ns, met))
        for x in set().union(*(m for _, _, m in after)):
            own = [(zs[x], ns[x]) for zs, ns, m in after if x in m]
            z[x], n[x] = (sum(v) / len(own) for v in zip(*own))
    return {x: w for x in z if (w := weight(x, z, n))}


def test_toxicity_against_plain_training(spark):
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").select("doc_id", "toxic")
    l1 = 1.0
    got = toxicity.fit(docs, labels, l1_grid=(l1,))
    from orderlens.llm.common import held_out
    rows = (docs.join(labels, "doc_id").filter(~held_out() & F.col("toxic").isin(0, 1))
            .withColumn("k", F.xxhash64("doc_id", F.lit(11)))
            .select("text", "toxic", F.pmod("k", F.lit(toxicity.SHARDS)).alias("shard"), F.xxhash64("k").alias("o"))
            .orderBy("o").collect())
    h, at = toxicity.word_hashes([r.text or "" for r in rows])
    plain = plain_ftrl([(r.shard, toxicity.features(h[s:e]).tolist(), r.toxic) for r, s, e in zip(rows, at, at[1:])],
                       l1, toxicity.SHARDS, toxicity.ROUNDS)
    assert abs(plain.pop("bias") - got.bias) < 5e-3
    own = dict(zip(got.place.tolist(), got.weight.tolist()))
    assert len(own) > 5 and all(abs(own.get(x, 0) - plain.get(x, 0)) < 1e-2 for x in {*own, *plain})
    # scores: the sum of the weights of a text's places
    table, sig = dict(own), lambda x: 1 / (1 + math.exp(-x))
    scored = rows_of(toxicity.score(docs, got))
    for r in docs.collect():
        h, at = toxicity.word_hashes([r.text or ""])
        assert abs(scored[r.doc_id].score - sig(got.bias + sum(table.get(x, 0) for x in toxicity.features(h).tolist()))) < 1e-5


def test_toxicity_without_labels_or_rows(spark, odd):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    w = toxicity.fit(odd, none)
    assert not len(w.place) and toxicity.score(odd, w).filter("predicted = 1").count() == 0
    assert toxicity.score(odd.limit(0), w).count() == 0


def test_toxicity_learns_a_word_with_two_toxic_rows_per_shard(spark):
    """Below the L1 bound in each round, above it over the four rounds."""
    import random

    from pyspark.sql import functions as F

    from orderlens.llm.common import held_out
    rnd, shards = random.Random(6), toxicity.SHARDS
    ids = spark.range(6000).withColumnRenamed("id", "doc_id").select(
        "doc_id", held_out().alias("held"), F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(shards)).alias("shard")).collect()
    planted = [r.doc_id for s in range(shards) for r in [x for x in ids if not x.held and x.shard == s][:2]]
    asked = [r.doc_id for r in ids if r.held][:10]
    rows = []
    for r in ids:
        toxic = r.doc_id % 20 == 0 or r.doc_id in planted or r.doc_id in asked
        words = [f"w{rnd.randrange(3000)}" for _ in range(8)]
        if r.doc_id in planted or r.doc_id in asked:
            words[4] = "rarecue"
        elif toxic:
            words[4] = "commoncue"
        rows.append((r.doc_id, " ".join(words), int(toxic)))
    d = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int").cache()
    w = toxicity.fit(d, d.select("doc_id", "toxic"), l1_grid=(4.0,))      # the bound that the case is about
    got = rows_of(toxicity.score(d, w))
    assert sum(got[i].predicted for i in asked) >= 9
    clean = [r.doc_id for r, (_, _, toxic) in zip(ids, rows) if r.held and not toxic]
    assert sum(got[i].predicted for i in clean) <= 0.02 * len(clean)


# ---- 10 quality

def brute_measures(t):
    t = t or ""
    w = [x for x in re.split("[\x20\x09-\x0D]+", t) if x]
    wins = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    rep = {k for i in range(len(w) - 7) if wins[tuple(w[i:i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in t.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(rep))


def test_quality_measures(spark, odd):
    for df in (spark.read.parquet(f"{SF_MID}/documents.parquet"), odd):
        got = quality_rules.measures(df).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                                "n_repeat_words")
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(
            str((r.doc_id, *brute_measures(r.text))) for r in df.collect())


def test_quality_verdict(spark, odd):
    got = rows_of(queries.op10_quality_rules(spark, SF_MID))
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) for r in got.values())
    assert not any(r.kept and r.base_failed for r in got.values())
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    good = [i for i in labels if labels[i] and not got[i].base_failed]
    assert sum(got[i].kept for i in good) >= 0.97 * len(good)
    assert quality_rules.judge(odd).count() == odd.count() and quality_rules.judge(odd.limit(0)).count() == 0


def test_em_finds_planted_accuracies(spark):
    import random
    rnd = random.Random(8)
    acc = {"a": 0.95, "b": 0.8, "c": 0.65, "d": 0.9}
    rows = []
    for _ in range(4000):
        y = 1 if rnd.random() < 0.7 else -1
        rows.append(tuple(0 if rnd.random() < 0.2 else y if rnd.random() < p else -y for p in acc.values()))
    df = spark.createDataFrame(rows, ", ".join(f"vote_{r} int" for r in acc))
    m = quality_rules.fit(df, list(acc), steps=60)
    assert abs(m.prior - 0.7) < 0.04
    assert all(abs(m.accuracy[r] - acc[r]) < 0.05 for r in acc)


def test_quality_posteriors_against_plain_em(spark):
    """EM over the votes of every document, in plain Python."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rules = list(quality_rules.votes())
    rows = quality_rules.judge(docs).collect()
    votes = [[r[f"vote_{x}"] for x in rules] for r in rows]
    prior, acc = 0.8, [0.75] * len(rules)

    def belief(v):
        odds = math.log(prior / (1 - prior)) + sum(x * math.log(a / (1 - a)) for x, a in zip(v, acc))
        return 1 / (1 + math.exp(-odds))
    for _ in range(30):
        p = [belief(v) for v in votes]
        new = []
        for k in range(len(rules)):
            right = sum(q if v[k] == 1 else 1 - q for v, q in zip(votes, p) if v[k])
            new.append((right + 30) / (sum(v[k] != 0 for v in votes) + 40))
        before = (prior, *acc)
        prior, acc = (sum(p) + 8) / (len(p) + 10), new
        if max(abs(x - y) for x, y in zip(before, (prior, *acc))) < 1e-5:
            break
    for r, v in zip(rows, votes):
        assert abs(r.posterior - belief(v)) < 1e-9
        assert r.kept == (not r.base_failed and r.posterior >= 0.5)


# ---- plans and the pipeline

NATIVE = {"op2_decontaminate", "op6_sharding", "op10_quality_rules"}


@pytest.mark.parametrize("name", sorted(NATIVE))
def test_native_plans(spark, name):
    plan = queries.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan)


def test_pipeline(spark):
    import corpus_pipeline as C
    assert [n for n, _ in C.STAGES] == ["language_id", "line_dedup", "near_dups", "decontaminate", "byte_bpe"]
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    kept = docs
    for _, stage in C.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, SF_MID).cache()
        assert kept.columns == docs.columns and 0 < kept.count() <= before.count()
    texts = {r.doc_id: r.text for r in kept.collect()}
    parts = brute_components(texts)
    assert all(parts[i][1] == i for i in texts)
    enc = tiktoken_model()
    got = rows_of(C.run(spark, SF_MID))
    assert {i: r.n_tokens for i, r in got.items()} == {i: len(enc.encode_ordinary(t or "")) for i, t in texts.items()}


def test_every_query_is_registered():
    import __spark_entry__ as E
    names = [q for q in E.queries() if re.match(r"op\d+_", q)]
    assert sorted(int(q[2:].split("_")[0]) for q in names) == list(range(1, 14)) and "pipeline" in E.queries()
    assert os.path.basename(E.__file__) == "__spark_entry__.py"
