"""Operator 5: near-duplicates by MinHash with banding, exact confirmation and components.

1. Each text becomes its set of word shingles (64-bit hashes).  Documents with equal sets form
   one class, so exact copies cost one row from here on.
2. A class has ``MINIMA`` universal hash minima; the first of them make the bucket keys.  Rows and number of the
   bands follow from the similarity that is asked for (``banding``): at exactly that similarity a pair
   shares no bucket with a probability of about 1e-5 (0.85: 36 bands of 8, 0.80: 49 of 7), and less
   above.  The signature keeps four bits of every minimum.
3. Links are confirmed on the full sets, without listing all pairs of a bucket.  The leader of a
   bucket is its most connected class (the one that meets most others over all its buckets: the
   original of edited copies, not just any copy).  Every class is compared with the leaders of its
   buckets.  In buckets that then still hold several components, pairs of different components
   follow if their sizes and signatures allow the similarity, each pair in one bucket only.
4. Components come from alternating large-star and small-star.

Class ids are 64-bit hashes of the sets (expected clashes: classes ** 2 / 2 ** 65).

Cases: null texts and texts without words have the empty set and link with nothing; a text of fewer
words than a shingle is one shingle; repeated rows are copies; a null ``doc_id`` takes the component's
least id; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.byte_hash import hash_stretches, mix
from orderlens.llm.common import blocks, fresh, id_and_text, materialise, texts_of
from orderlens.llm.components import connected_components

SHINGLE = 5
PERCENT = 85
MINIMA = 576                               # of the signature; the first bands * rows make the buckets
MISSED = 1.1e-5                            # share of pairs at the threshold that may meet in no bucket
# Pairs (two 64-bit ids each) that are broadcast at most; more are joined by shuffles.
BROADCAST_PAIRS = 2_000_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_STRETCH = 1 << 18
_rng = np.random.Generator(np.random.PCG64(771))
_PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_A = _rng.integers(0, 1 << 31, MINIMA, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 1 << 32, MINIMA, dtype=np.uint32)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (runs without ASCII white space, A-Z lower-cased), bounds of the texts."""
    raw = [t.encode() for t in texts]
    buf = _LOWER[np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)]
    silent = _SPACE[buf]
    starts = np.flatnonzero(~silent & np.concatenate([[True], silent[:-1]]))
    return (hash_stretches(buf, starts, silent),
            np.searchsorted(starts, np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])])))


def shingle_set(w: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``size`` words (fewer words: the whole run)."""
    if not len(w):
        return w
    k = min(size, len(w))
    parts = []
    for lo in range(0, len(w) - k + 1, _STRETCH):      # temporaries of a long text stay small
        hi = min(lo + _STRETCH, len(w) - k + 1)
        total = np.full(hi - lo, k, np.uint64)
        for j in range(k):
            total += w[lo + j:hi + j] * _PLACE[j]
        parts.append(np.unique(mix(total)))
    return parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))


def signature(s: np.ndarray) -> np.ndarray:
    """The minima of the universal hashes ``a * x + b`` (mod 2 ** 32) over a set."""
    x = (s >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(_A), np.iinfo(np.uint32).max, np.uint32)
    step = max(1, (1 << 16) // len(_A))
    for lo in range(0, len(x), step):
        part = np.multiply.outer(_A, x[lo:lo + step])
        part += _B[:, None]
        np.minimum(out, part.min(axis=1), out=out)
    return out


def banding(percent: int) -> tuple[int, int]:
    """Bands and rows: the most rows whose bands, at most 5/8 of the minima, miss a share of ``MISSED`` at most."""
    for rows in range(8, 0, -1):
        shared = (percent / 100) ** rows
        bands = 1 if shared == 1 else math.ceil(math.log(MISSED) / math.log(1 - shared))
        if bands * rows <= MINIMA * 5 // 8:
            return bands, rows
    return MINIMA, 1


def least_equal(percent: int) -> int:
    """Equal four-bit minima that a pair needs: 4.5 deviations less than the mean at the threshold, where
    each agrees with probability ``s + (1 - s) / 16`` (0.85: 457 of 576)."""
    p = percent / 100 + (1 - percent / 100) / 16
    return int(MINIMA * p - 4.5 * math.sqrt(MINIMA * p * (1 - p)))


def bucket_keys(sig: np.ndarray, bands: int, size: int) -> np.ndarray:
    rows = sig[:bands * size].reshape(bands, size).astype(np.uint64)
    total = np.arange(bands, dtype=np.uint64)
    for j in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + mix(rows[:, j] + np.uint64(1))
    return mix(total)


def nibbles(sig: np.ndarray) -> np.ndarray:
    """Four bits of every minimum, packed into 64-bit words."""
    four = (mix(sig.astype(np.uint64)) >> np.uint64(60)).astype(np.uint64).reshape(-1, 16)
    return (four << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(axis=1, dtype=np.uint64)


def _class_id(s: np.ndarray) -> np.uint64:
    """Two sums over the set, mixed: equal for equal sets."""
    sums = np.array([s.sum(dtype=np.uint64), mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)])
    return mix(mix(sums[:1] + np.uint64(len(s))) ^ sums[1:])[0]


def describe(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, th, n, c`` (class), ``buckets`` and ``sig`` for ``docs (doc_id, th, text)``."""
    bands, size = banding(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple] = {}                  # copies near each other share the signature
        for b in blocks(batches):
            h, at = word_hashes(texts_of(b))
            n, c, keys, sigs = [], [], [], []
            for lo, hi in zip(at, at[1:]):
                s = shingle_set(h[lo:hi])
                n.append(len(s))
                if not len(s):
                    c.append(None), keys.append(None), sigs.append(None)
                    continue
                own = int(_class_id(s).view(np.int64))
                if own not in known:
                    if len(known) > 2000:
                        known.clear()
                    sig = signature(s)
                    known[own] = (bucket_keys(sig, bands, size).view(np.int64), nibbles(sig).view(np.int64))
                c.append(own), keys.append(known[own][0]), sigs.append(known[own][1])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("th"), pa.array(n, pa.int64()), pa.array(c, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(sigs, pa.list_(pa.int64()))],
                names=["doc_id", "th", "n", "c", "buckets", "sig"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.mapInArrow(run, f"doc_id {kind}, th bigint, n bigint, c bigint, buckets array<bigint>, sig array<bigint>")


def _sets_of(docs: DataFrame) -> DataFrame:
    """``c, shingles`` for ``docs (c, text)``, only where the text is of class ``c``: an id may
    stand for rows of several classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            h, at = word_hashes(texts_of(b))
            sets = [shingle_set(h[lo:hi]) for lo, hi in zip(at, at[1:])]
            own = pa.array([len(s) > 0 and int(_class_id(s).view(np.int64)) == c
                            for s, c in zip(sets, b.column("c").to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [b.column("c"), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                names=["c", "shingles"]).filter(own)

    return docs.mapInArrow(run, "c bigint, shingles array<bigint>")


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_PAIRS else df


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(u, v)`` whose full sets are similar enough.

    The list of pairs goes to the sets of ``u`` (broadcast while small); those sets then meet the
    sets of ``v``, which adaptive execution splits when one ``v`` is hot.
    """
    pairs = materialise(pairs, "candidate_pairs")
    rows = pairs.count()
    left = sets.join(_small(pairs, rows), F.col("c") == F.col("u")).select("u", "v", F.col("shingles").alias("su"))
    right = (sets.join(_small(pairs.select("v").distinct().withColumnRenamed("v", "c"), rows), "c", "left_semi")
             .select(F.col("c").alias("v"), F.col("shingles").alias("sv")))
    both = left.join(right, "v").withColumn("common", F.size(F.array_intersect("su", "sv")))
    return materialise(both.filter(100 * F.col("common")
                                   >= percent * (F.size("su") + F.size("sv") - F.col("common"))).select("u", "v"),
                       "confirmed_links")


_ONES = 0x1111111111111111                 # the lowest bit of each nibble


def _equal_minima(a: str, b: str) -> Column:
    """How many four-bit minima of two signatures agree (zero nibbles of the exclusive or)."""
    total = F.lit(0)
    for k in range(MINIMA // 16):
        x = F.get(F.col(f"{a}.sig"), F.lit(k)).bitwiseXOR(F.get(F.col(f"{b}.sig"), F.lit(k)))
        two = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        any_bit = two.bitwiseOR(F.shiftrightunsigned(two, 2))
        total = total + (F.lit(16) - F.bit_count(any_bit.bitwiseAND(F.lit(_ONES))))
    return total


def _allowed(a: str, b: str, percent: int) -> Column:
    """Sizes and signatures of two classes do not rule out the similarity, and this is their first bucket."""
    least = F.least(F.col(f"{a}.n"), F.col(f"{b}.n")) * 100 >= F.greatest(F.col(f"{a}.n"), F.col(f"{b}.n")) * percent
    first = F.array_min(F.array_intersect(F.col(f"{a}.buckets"), F.col(f"{b}.buckets"))) == F.col(f"{a}.bucket")
    return least & (_equal_minima(a, b) >= least_equal(percent)) & first


class Groups(NamedTuple):
    """``documents (doc_id, th, n, c)``, ``classes (c, rep)`` and ``components (node, root)`` of classes."""
    documents: DataFrame
    classes: DataFrame
    components: DataFrame


def _label(rows: DataFrame, components: DataFrame, key: str, out: str) -> DataFrame:
    """``rows`` with the component of ``key``; a class without links is its own."""
    own = components.select(F.col("node").alias(key), F.col("root").alias("_root"))
    return rows.join(own, key, "left").withColumn(out, F.coalesce("_root", key)).drop("_root")


def find(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> Groups:
    """Classes and their components; runs Spark jobs when called."""
    own = id_and_text(docs, id_col, text_col)
    described = materialise(describe(own.withColumn("th", F.xxhash64("text")), percent), "minhash")
    documents = described.select("doc_id", "th", "n", "c")
    full = described.filter("n > 0")
    classes = materialise(full.groupBy("c").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig"),
        F.first("buckets").alias("buckets")), "minhash_classes")
    rows = classes.select("c", F.explode("buckets").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count("*").alias("m")).filter("m > 1")
    inside = materialise(rows.join(shared, "bucket"), "minhash_inside")
    # how many other classes a class meets over all its buckets
    met = inside.groupBy("c").agg(F.sum(F.col("m") - 1).alias("met"))
    ranked = inside.join(met, "c").withColumn("rank", F.struct("met", (-F.col("c")).alias("tie"), "c"))
    leads = ranked.groupBy("bucket").agg(F.max("rank").alias("lead")).select("bucket", F.col("lead.c").alias("lead"))
    members = materialise(inside.select("c", "bucket").join(leads, "bucket"), "minhash_members")

    # sets only of classes that share a bucket; one document stands for each class
    wanted = materialise(members.select("c").distinct().join(classes.select("c", "rep"), "c"), "minhash_wanted")
    n_wanted = wanted.count()
    texts = own.join(_small(wanted.select("rep", F.col("c").alias("wc")), n_wanted),
                     F.col("doc_id").eqNullSafe(F.col("rep")))
    sets = materialise(_sets_of(texts.select(F.col("wc").alias("c"), "text")), "minhash_sets")

    led = members.filter("c <> lead").select(F.col("c").alias("u"), F.col("lead").alias("v")).distinct()
    links = _confirmed(led, sets, percent)
    parts = connected_components(links)

    here = _label(members, parts, "c", "part")
    open_buckets = here.groupBy("bucket").agg(F.min("part").alias("p1"), F.max("part").alias("p2")).filter("p1 <> p2")
    # sizes that allow the similarity differ by one step of this scale at most
    step = F.floor(F.log(F.col("n")) / F.log(F.lit(100.0 / percent)) + 1e-9)
    rest = materialise(here.filter("c <> lead").join(open_buckets.select("bucket"), "bucket", "left_semi")
                       .join(classes.select("c", "n", "sig", "buckets"), "c").withColumn("k", step), "minhash_open")
    a = rest.withColumn("k", F.explode(F.array(F.col("k"), F.col("k") + 1))).alias("a")
    b = rest.alias("b")
    cross = (a.join(b, (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.k") == F.col("b.k"))
                    & (F.col("a.part") != F.col("b.part")) & (F.col("a.c") != F.col("b.c"))
                    & _allowed("a", "b", percent))
             .select(F.least("a.c", "b.c").alias("u"), F.greatest("a.c", "b.c").alias("v")).distinct())
    more = _confirmed(cross, sets, percent)
    if not more.isEmpty():                        # the stars found so far stand for their links
        stars = parts.filter("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v"))
        parts = connected_components(stars.unionByName(more))
    return Groups(documents, classes.select("c", "rep"), parts)


def groups(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, c, root`` per input row."""
    g = find(docs, percent, id_col, text_col)
    labelled = _label(g.classes, g.components, "c", "root")
    least = labelled.groupBy("root").agg(F.min("rep").alias("component_id"))
    by_class = labelled.join(least, "root").select("c", "root", "component_id")
    return (g.documents.join(by_class, "c", "left")
            .withColumn("component_id", F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")))
            .select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                    F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "c", "root"))


def keep_one(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, without near-duplicates: of each component the row with the
    least id stays (of rows that share it, one).  Texts without words all stay."""
    g = find(docs, percent, id_col, text_col)
    labelled = _label(g.classes, g.components, "c", "root")
    first = labelled.groupBy("root").agg(F.min(F.struct("rep", "c")).alias("first"))
    stays = first.select(F.col("first.c").alias("c"), F.col("first.rep").alias("rep"), F.lit(True).alias("is_first"))
    rows = g.documents.filter("n > 0").groupBy("doc_id", "th", "c").agg(F.count("*").alias("k"))
    marked = (rows.join(stays, "c", "left")
              .withColumn("stays", F.coalesce(F.col("is_first") & F.col("doc_id").eqNullSafe(F.col("rep")), F.lit(False))))
    # texts of one id and class that differ in white space or letter case: the least hash stays
    least = (marked.filter("stays").groupBy("doc_id", "c").agg(F.min("th").alias("least"))
             .select(F.col("doc_id").alias("kd"), F.col("c").alias("kc"), "least"))
    final = materialise(
        marked.join(least, F.col("doc_id").eqNullSafe(F.col("kd")) & (F.col("c") == F.col("kc")), "left")
        .select("doc_id", "th", "k", (F.col("stays") & (F.col("th") == F.col("least"))).alias("stays")), "near_dup_rows")
    totals = final.agg(F.sum(F.when(F.col("stays"), 0).otherwise(1)).alias("gone"),
                       F.max(F.when(F.col("stays"), F.col("k"))).alias("most")).first()
    own, d, t = (fresh(docs, x) for x in ("text_hash", "gone_doc", "gone_hash"))
    gone = _small(final.filter(~F.coalesce("stays", F.lit(False))).select(
        F.col("doc_id").alias(d), F.col("th").alias(t)), totals.gone or 0)
    left = (docs.withColumn(own, F.xxhash64(F.col(text_col)))
            .join(gone, F.col(id_col).eqNullSafe(F.col(d)) & (F.col(own) == F.col(t)), "left_anti"))
    if (totals.most or 1) > 1:                    # rows repeated whole: one of them
        blank = F.coalesce(F.btrim(F.col(text_col), F.lit(" \t\n\x0b\x0c\r")), F.lit("")) == ""
        left = left.filter(blank).unionByName(left.filter(~blank).dropDuplicates([id_col, own]))
    return left.drop(own)


ORACLE_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS sh FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
c AS (
  SELECT a.doc_id AS u, b.doc_id AS v, any_value(a.n) AS nu, any_value(b.n) AS nv, COUNT(*) AS common
  FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT u, v FROM c WHERE 100 * common >= 85 * (nu + nv - common)),
b AS (SELECT u, v FROM l UNION ALL SELECT v, u FROM l),
r AS (SELECT doc_id AS d, doc_id AS m FROM documents UNION SELECT b.v, r.m FROM r JOIN b ON b.u = r.d)
SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, g.m AS component_id, s.doc_id = g.m AS kept
FROM s JOIN (SELECT d, MIN(m) AS m FROM r GROUP BY d) g ON g.d = s.doc_id
"""
