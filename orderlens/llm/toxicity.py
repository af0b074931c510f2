"""Operator 9: toxicity by FTRL-proximal logistic regression over hashed word features.

Features are the words, word pairs and skip-grams (a word and the one after the next) of the
whole text, lower-cased, hashed into two tables of ``2 ** BITS`` places (words apart from pairs), each
counted once per document.  FTRL keeps per coordinate a sum ``z`` and a squared-gradient sum
``n``; the learning rate of a coordinate falls with its own ``n``, and L1 keeps most weights at
exactly zero, so the model that is broadcast is a short list of (place, weight).

Training: a hash sample of at most about ``MAX_ROWS`` labelled rows is turned into features once
and dealt once over ``SHARDS`` tasks, which keep them.  In each of ``ROUNDS`` rounds
every shard goes on from the common state over its own rows, and a coordinate's new state is the
mean over the shards that met it.  That mean is taken on executors, place range by place range, and
written under the checkpoint folder, where the next round's tasks read it; only non-zero weights come to the
driver.  State below the L1 bound is kept too, since it adds up over rounds; between rounds ``z`` has 32 bits and
the root of ``n`` 16.

L1 is chosen from ``L1_GRID`` on a hash sample of about ``TRIAL_ROWS`` of these rows: one task per value trains (same
shards and rounds) on four fifths of it, and the value with the least log-loss on the rest is taken.

Cases: null and empty texts score as the bias alone; labels that are null or not 0/1 are ignored;
several labels of one document all count; without labels of both kinds scores are the smoothed share
of toxic labels; repeated rows get equal results; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.byte_hash import hash_stretches, mix
from orderlens.llm.common import blocks, filesystem, held_out, id_and_text, new_folder, texts_of

BITS = 20
MAX_ROWS = 100_000
SHARDS = 4
ROUNDS = 4
ALPHA, BETA, L2 = 5.0, 1.0, 0.01
L1_GRID = (0.5, 1.0, 2.0, 4.0)
TRIAL_ROWS, FOLDS = 3000, 5
RANGES = 64                  # place ranges whose states are averaged apart
TOXIC_AT = 0.3

# ASCII letters (lower-cased), digits and all bytes of other characters form words.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_BREAK = np.array([not (chr(b).isalnum() or b >= 0x80) for b in range(256)], bool)
_NEAR, _SKIP = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


class Weights(NamedTuple):
    place: np.ndarray        # ascending
    weight: np.ndarray
    bias: float


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and the ``len(texts) + 1`` bounds of the texts in them."""
    raw = [t.encode() for t in texts]
    buf = _LOWER[np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)]
    silent = _BREAK[buf]
    before = np.concatenate([[True], silent[:-1]])
    starts = np.flatnonzero(~silent & before)
    ends = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])])
    return hash_stretches(buf, starts, silent), np.searchsorted(starts, ends)


def features(w: np.ndarray) -> np.ndarray:
    """Distinct places of one document's words, pairs and skip-grams."""
    shift = np.uint64(64 - BITS)
    parts = [(w >> shift).astype(np.int32)]
    for gap, factor in ((1, _NEAR), (2, _SKIP)):
        if len(w) > gap:
            parts.append((mix(w[:-gap] * factor + w[gap:]) >> shift).astype(np.int32) + (1 << BITS))
    return np.unique(np.concatenate(parts))


_SIZE = (2 << BITS) + 1                    # places of both tables, and the bias
_STEP = -(-_SIZE // RANGES)


def _weight(z: np.ndarray, n: np.ndarray, l1: float) -> np.ndarray:
    return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def _bias(z: float, n: float) -> float:
    """The last place has no L1."""
    return -z / ((BETA + math.sqrt(n)) / ALPHA + L2)


def _weights_at(x: np.ndarray, z: np.ndarray, n: np.ndarray, l1: float) -> tuple:
    """State and weights of the places ``x``; the last of them is the bias."""
    zx, nx = z[x], n[x]
    w = _weight(zx, nx, l1)
    w[-1] = _bias(zx[-1], nx[-1])
    return zx, nx, w


def _probability(total: float) -> float:
    return 1 / (1 + math.exp(-max(min(total, 35.0), -35.0)))


def epoch(z: np.ndarray, n: np.ndarray, rows, l1: float, met: np.ndarray) -> None:
    """One pass of FTRL-proximal over (places, label)."""
    for places, y in rows:
        x = np.append(places, _SIZE - 1)
        zx, nx, w = _weights_at(x, z, n, l1)
        g = _probability(float(w.sum())) - y
        square = nx + g * g
        z[x] = zx + g - (np.sqrt(square) - np.sqrt(nx)) / ALPHA * w
        n[x] = square
        met[x] = True


def _start(prior: float) -> tuple[np.ndarray, np.ndarray]:
    z, n = np.zeros(_SIZE), np.zeros(_SIZE)
    n[-1], z[-1] = 1.0, -math.log(prior / (1 - prior)) * ((BETA + 1.0) / ALPHA + L2)
    return z, n


def _rows(batch) -> Iterator[tuple[np.ndarray, int]]:
    for places, y in zip(batch["places"], batch["y"].to_pylist()):
        yield np.frombuffer(places.as_buffer(), np.int32), y


class State(NamedTuple):
    """Where the rounds of a training lie, how many there are, and what the state was before."""
    folder: str
    rounds: int
    prior: float

    def load(self) -> tuple[np.ndarray, np.ndarray]:
        """``z`` and ``n``; a later round replaces what an earlier one left."""
        z, n = _start(self.prior)
        for r in range(self.rounds):
            fs, base = filesystem(f"{self.folder}/round_{r}")
            for batch in pq.read_table(base, filesystem=fs).to_batches():
                for row in batch.to_pylist():
                    at, own_z, own_n = _unpacked(row)
                    z[at], n[at] = own_z, own_n
        return z, n


_STATE = "part int, met binary, z binary, root binary"


def _packed(part: int, met: np.ndarray, z: np.ndarray, n: np.ndarray) -> list:
    """A range: which of its places are met (a bit each), and their state."""
    return [part, np.packbits(met).tobytes(), z[met].astype(np.float32).tobytes(), np.sqrt(n[met]).astype(np.float16).tobytes()]


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, ``z`` and ``n`` of a range."""
    at = np.flatnonzero(np.unpackbits(np.frombuffer(row["met"], np.uint8))) + row["part"] * _STEP
    return at, np.frombuffer(row["z"], np.float32), np.frombuffer(row["root"], np.float16).astype(np.float64) ** 2


def _table(records: list[list]) -> pa.Table:
    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.table({c: pa.array([r[i] for r in records], k) for i, (c, k) in enumerate(zip(("part", "met", "z", "root"), kinds))})


def _train(dealt: DataFrame, prior: float, l1: float, rounds: int) -> State:
    """Rounds over the shards; states stay on the executors and in the shared folder."""
    state = State(new_folder(dealt.sparkSession, "toxicity_state"), 0, prior)

    def left(z: np.ndarray, n: np.ndarray, met: np.ndarray) -> Iterator[pa.RecordBatch]:
        for r in range(RANGES):
            own = slice(r * _STEP, (r + 1) * _STEP)
            if met[own].any():
                yield from _table([_packed(r, met[own], z[own], n[own])]).to_batches()

    def shard(batches: Iterator[pa.RecordBatch], now: State) -> Iterator[pa.RecordBatch]:
        own = None                                    # a task may hold several shards, one after the other
        for b in batches:
            numbers = b.column("shard").to_numpy()
            for part in np.split(np.arange(len(numbers)), np.flatnonzero(np.diff(numbers)) + 1):
                if len(part) and numbers[part[0]] != own:
                    if own is not None:
                        yield from left(z, n, met)
                    own = numbers[part[0]]
                    (z, n), met = now.load(), np.zeros(_SIZE, bool)
                if len(part):
                    epoch(z, n, _rows(b.slice(part[0], len(part))), l1, met)
        if own is not None:
            yield from left(z, n, met)

    def mean(key: tuple, group: pa.Table) -> pa.Table:
        part = key[0].as_py()
        total, seen = np.zeros((2, _STEP)), np.zeros(_STEP)
        for row in group.to_pylist():
            at, z, n = _unpacked(row)
            total[:, at - part * _STEP] += (z, n)
            seen[at - part * _STEP] += 1
        return _table([_packed(part, seen > 0, *(total / np.maximum(seen, 1)))])

    for r in range(rounds):
        (dealt.mapInArrow(lambda batches, now=state: shard(batches, now), _STATE)
         .groupBy("part").applyInArrow(mean, _STATE).write.parquet(f"{state.folder}/round_{r}"))
        state = state._replace(rounds=r + 1)
    return state


def trial(rows: list[tuple[int, np.ndarray, int]], asked: list[tuple[np.ndarray, int]], prior: float, l1: float,
          rounds: int) -> float:
    """Log-loss over ``asked`` after the same training on a few rows (shard, places, label), in one place."""
    z, n = _start(prior)
    shards = sorted({s for s, _, _ in rows})
    for _ in range(rounds):
        total, seen = np.zeros((2, _SIZE)), np.zeros(_SIZE)
        for s in shards:
            own_z, own_n, met = z.copy(), n.copy(), np.zeros(_SIZE, bool)
            epoch(own_z, own_n, ((x, y) for k, x, y in rows if k == s), l1, met)
            total[:, met] += (own_z[met], own_n[met])
            seen += met
        on = seen > 0
        z[on], n[on] = total[:, on] / seen[on]
    loss = 0.0
    for x, y in asked:
        p = _probability(float(_weights_at(np.append(x, _SIZE - 1), z, n, l1)[2].sum()))
        loss -= math.log(p if y else 1 - p)
    return loss


def _choose_l1(dealt: DataFrame, share: float, grid: tuple[float, ...], prior: float, rounds: int) -> float:
    """The value with the least loss on the trial rows; the largest of equal ones."""
    if len(grid) == 1:
        return grid[0]
    limit = int(min(1.0, share) * (1 << 31))

    def run(key: tuple, group: pa.Table) -> pa.Table:
        own = group.sort_by([("h", "ascending"), ("y", "ascending")])
        rows = list(zip(own["fold"].to_pylist(), own["shard"].to_pylist(), _rows(own)))
        loss = trial([(s, x, y) for f, s, (x, y) in rows if f], [xy for f, _, xy in rows if not f], prior,
                     key[0].as_py(), rounds)
        return pa.table({"l1": [key[0].as_py()], "loss": [loss]})

    sample = (dealt.filter(F.pmod(F.xxhash64("k", F.lit(13)), F.lit(1 << 31)) < limit)
              .select("shard", "y", "places", F.xxhash64("k").alias("h"),
                      F.pmod(F.xxhash64("k", F.lit(5)), F.lit(FOLDS)).alias("fold"),
                      F.explode(F.array(*map(F.lit, grid))).alias("l1")))
    got = sample.groupBy("l1").applyInArrow(run, "l1 double, loss double").collect()
    return min(got, key=lambda r: (r.loss, -r.l1)).l1 if got else max(grid)


def _weights(spark: SparkSession, state: State, l1: float) -> Weights:
    """The non-zero weights, found range by range on the executors, and the bias."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        part = key[0].as_py()
        z, n = np.zeros(_STEP), np.zeros(_STEP)
        for row in sorted(group.to_pylist(), key=lambda r: r["round"]):
            at, own_z, own_n = _unpacked(row)
            z[at - part * _STEP], n[at - part * _STEP] = own_z, own_n
        w, last = _weight(z, n, l1), _SIZE - 1 - part * _STEP
        if 0 <= last < _STEP:
            w[last] = _bias(z[last], n[last])
        at = np.flatnonzero(w)
        return pa.table({"place": [(at + part * _STEP).astype(np.int64).tobytes()], "weight": [w[at].tobytes()]})

    rows = None
    for r in range(state.rounds):
        own = spark.read.schema(_STATE).parquet(f"{state.folder}/round_{r}").withColumn("round", F.lit(r))
        rows = own if rows is None else rows.unionByName(own)
    found = rows.groupBy("part").applyInArrow(run, "place binary, weight binary").collect()
    place = np.concatenate([np.frombuffer(r.place, np.int64) for r in found])
    weight = np.concatenate([np.frombuffer(r.weight, np.float64) for r in found])
    order = np.argsort(place)
    place, weight = place[order], weight[order]
    bias = float(weight[place == _SIZE - 1].sum())
    return Weights(place[place < _SIZE - 1], weight[place < _SIZE - 1], bias)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, shards: int = SHARDS,
        rounds: int = ROUNDS, l1_grid: tuple[float, ...] = L1_GRID, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> Weights:
    """Train on rows that are not held out; runs Spark jobs when called."""
    usable = labels.filter(~held_out(id_col) & F.col(label_col).isin(0, 1)).select(
        F.col(id_col).alias("label_id"), F.col(label_col).cast("int").alias("y"))
    count = usable.agg(F.count("*").alias("n"), F.sum("y").alias("pos")).first()
    n, pos = count["n"], count["pos"] or 0
    prior = (pos + 0.1) / (n + 1.0)
    if not pos or pos == n:
        return Weights(np.empty(0, np.int64), np.empty(0), math.log(prior / (1 - prior)))
    limit = int(min(1.0, max_rows / n) * (1 << 31))
    # about max_rows rows of (id, label) at most: a broadcast of bounded size
    picked = usable.filter(F.pmod(F.xxhash64("label_id", F.lit(7)), F.lit(1 << 31)) < limit)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            h, at = word_hashes(texts_of(b))
            found = [features(h[s:e]).tobytes() for s, e in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays([b.column("k"), b.column("y"), pa.array(found, pa.binary())],
                                             names=["k", "y", "places"])

    own = (id_and_text(docs, id_col, text_col).join(F.broadcast(picked), F.col("doc_id") == F.col("label_id"))
           .select(F.xxhash64("doc_id", F.lit(11)).alias("k"), "y", "text"))
    # dealt once, over enough partitions that few share one; all rounds read the same shards
    dealt = (own.mapInArrow(extract, "k bigint, y int, places binary").withColumn("shard", F.pmod("k", F.lit(shards)).cast("int"))
             .repartition(4 * shards, "shard").sortWithinPartitions("shard", F.xxhash64("k"), "y")
             .persist(StorageLevel.MEMORY_AND_DISK))
    try:
        l1 = _choose_l1(dealt, TRIAL_ROWS / min(n, max_rows), tuple(l1_grid), prior, rounds)
        return _weights(docs.sparkSession, _train(dealt, prior, l1, rounds), l1)
    finally:
        dealt.unpersist()


def score(docs: DataFrame, weights: Weights, toxic_at: float = TOXIC_AT, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` per input row."""
    sent = docs.sparkSession.sparkContext.broadcast(tuple(weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, weight, bias = sent.value
        table = np.zeros(2 << BITS, np.float32)
        table[place] = weight
        shift = np.uint64(64 - BITS)
        for b in blocks(batches):
            h, at = word_hashes(texts_of(b))
            doc = np.repeat(np.arange(b.num_rows), np.diff(at))
            hit_place, hit_doc = [], []
            for gap, factor in ((0, None), (1, _NEAR), (2, _SKIP)):
                if len(h) <= gap:
                    continue
                if gap:
                    p = (mix(h[:-gap] * factor + h[gap:]) >> shift).astype(np.int64) + (1 << BITS)
                    same = doc[:-gap] == doc[gap:]
                    on = np.flatnonzero(same & (table[p] != 0))
                else:
                    p = (h >> shift).astype(np.int64)
                    on = np.flatnonzero(table[p] != 0)
                hit_place.append(p[on])
                hit_doc.append(doc[on])
            total = np.full(b.num_rows, bias)
            if hit_place:
                key = np.unique(np.concatenate(hit_doc) * (2 << BITS) + np.concatenate(hit_place))
                np.add.at(total, key // (2 << BITS), table[key % (2 << BITS)])
            s = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(s),
                 pa.array((s >= toxic_at).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    kind = dict(docs.dtypes)[id_col]
    return (id_and_text(docs, id_col, text_col).select("doc_id", held_out().alias("held_out"), "text")
            .mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int"))
