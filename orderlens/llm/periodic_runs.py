"""Operator 12: periodic runs of words by the branching-tandem test on an enhanced suffix array.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are equal), at
least ``MIN_EXPONENT * q`` and ``MIN_LENGTH`` words long, that no neighbouring word extends.  Every document
is judged by itself, whole; the documents of a block share the numpy passes.

1. Words become 64-bit hashes, mixed with the document's number, so suffixes of different documents have
   nothing in common.  The suffix array comes from prefix doubling, only over suffixes still tied;
   the ranks of each level are kept as names of the ``2 ** level``-word grams.
2. Longest common prefixes of neighbours follow from those names, from the highest level down, and
   LCP intervals are slot ranges found by pointer jumping to the next smaller value; no tree is built.
3. Branching tandem test: for every LCP interval of depth ``d`` and every suffix ``i`` of its children but
   the largest, ``i + d`` and ``i - d`` are looked up in the inverse suffix array.  One that lies in the interval
   and in another child gives a square of period ``d`` that no word prolongs to the right.  An interval of
   fewer than ``MIN_EXPONENT`` suffixes cannot hold a run that is long enough.
4. Squares are rotated to the left as far as the words agree (by gram names, in halving steps),
   which gives the whole run; runs of one stretch merge into that of the smallest period.

A word of a run goes if some run holds it after the run's first ``q`` words.

Memory is bounded by the longest text (some 60 bytes a word, and 4 a word for each level in which an
eighth of its suffixes are tied).  Word hashes clash with probability ``words ** 2 / 2 ** 65`` in a block.

Cases: null and empty texts have no words, no runs and an empty collapsed text; a null ``doc_id`` is kept;
repeated rows give repeated results; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from orderlens.llm.byte_hash import hash_stretches, mix
from orderlens.llm.common import blocks, id_and_text, texts_of

MIN_EXPONENT, MIN_LENGTH = 4, 6
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_CHUNK = 1 << 20                       # suffixes or words that are looked at together


def ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges ``[lo, hi)`` one after the other, and the range of each."""
    size = hi - lo
    which = np.repeat(np.arange(len(lo)), size)
    return np.arange(len(which)) - np.repeat(np.cumsum(size) - size - lo, size), which


class SuffixArray:
    """``order`` (suffixes sorted), ``slot`` (its inverse) and names of the grams of ``2 ** level`` words.

    ``words`` are hashes, ``bounds`` the ``documents + 1`` places where documents begin."""

    def __init__(self, words: np.ndarray, bounds: np.ndarray):
        n = self.n = len(words)
        size = np.diff(bounds)
        own = words + np.repeat(mix(np.arange(1, len(bounds), dtype=np.uint64)), size)
        end = np.repeat(bounds[1:], size)
        self.order = np.argsort(own, kind="stable").astype(np.int32)
        key = own[self.order]
        rank = np.empty(n + 1, np.int32)
        rank[n] = n                                   # behind the last word: a name of its own
        self.levels: list[tuple] = []
        slots, at = np.arange(n, dtype=np.int32), self.order
        step = 1
        while True:
            fresh = np.empty(len(key), bool)
            if len(key):
                fresh[0] = True
                fresh[1:] = key[1:] != key[:-1]
            head = slots[np.maximum.accumulate(np.where(fresh, np.arange(len(key)), 0))] if len(key) else slots
            rank[at] = head
            tied = ~fresh
            tied[:-1] |= tied[1:]
            slots, at = slots[tied], at[tied]
            if not len(at):
                break
            self._keep(rank, at)
            # the words after the gram; a suffix that ends there comes first and is alone with that
            after = at.astype(np.int64) + step
            key = rank[at].astype(np.int64) * (n + 2) + np.where(after < end[at], rank[np.minimum(after, n)] + 1, 0)
            by = np.argsort(key, kind="stable")
            at, key = at[by], key[by]
            self.order[slots] = at
            step *= 2
        self.slot = rank                              # all ranks differ now

    def _keep(self, rank: np.ndarray, tied: np.ndarray) -> None:
        if len(tied) * 8 < self.n:
            at = np.sort(tied)
            self.levels.append((at, rank[at]))
        else:
            names = np.full(self.n + 1, -1, np.int32)
            names[tied] = rank[tied]
            self.levels.append((None, names))

    def _names(self, level: int, at: np.ndarray) -> np.ndarray:
        """Names of the grams that begin at ``at``; -1 for a gram that is alone."""
        where, names = self.levels[level]
        if where is None:
            return names[at]
        place = np.minimum(np.searchsorted(where, at), len(where) - 1)
        return np.where(where[place] == at, names[place], -1)

    def same(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Do the ``2 ** level`` words from ``a`` equal those from ``b`` (another place)?"""
        x = self._names(level, a)
        return (x >= 0) & (x == self._names(level, b))

    def common_prefixes(self) -> tuple[np.ndarray, np.ndarray]:
        """Slots whose suffix shares words with that of the slot before, and how many."""
        sub = np.arange(1, self.n)
        shared = []
        for level in range(len(self.levels)):
            sub = sub[self.same(level, self.order[sub - 1], self.order[sub])]
            shared.append(sub)
        length = np.zeros(self.n, np.int32)
        for level in reversed(range(len(shared))):
            s = shared[level]
            a, b = self.order[s - 1] + length[s], self.order[s] + length[s]
            length[s[self.same(level, a, b)]] += 1 << level
        slots = shared[0] if shared else np.zeros(0, int)
        return slots, length[slots]


def intervals(n: int, slots: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First slot, and the one after the last, of the LCP interval that each of ``slots`` lies inside."""
    lcp = np.full(n + 1, 0, np.int32)
    lcp[slots] = length
    out = []
    for direction in (-1, 1):
        jump = np.arange(n + 1) + direction           # everything between is no smaller
        todo = slots[lcp[jump[slots]] >= lcp[slots]]
        while len(todo):
            jump[todo] = jump[jump[todo]]
            todo = todo[lcp[jump[todo]] >= lcp[todo]]
        out.append(jump[slots])
    return out[0], out[1]


def tandems(sa: SuffixArray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of the squares that no word prolongs; some may appear twice."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    slots, length = sa.common_prefixes()
    lb, rb = intervals(sa.n, slots, length)
    on = rb - lb >= least
    slots, length, lb, rb = slots[on], length[on].astype(np.int64), lb[on], rb[on]
    if not len(slots):
        return none
    # the children of an interval lie between its slots of its own depth
    by = np.argsort(lb * (sa.n + 1) + rb, kind="stable")
    slots, length, lb, rb = slots[by], length[by], lb[by], rb[by]
    new = np.concatenate([[True], (lb[1:] != lb[:-1]) | (rb[1:] != rb[:-1])])
    first = np.flatnonzero(new)
    many = np.diff(np.concatenate([first, [len(slots)]]))          # slots of each interval
    group = np.repeat(np.arange(len(first)), many + 1)
    is_last = np.zeros(len(group), bool)
    is_last[np.cumsum(many + 1) - 1] = True
    hi = np.empty(len(group), np.int64)
    hi[~is_last], hi[is_last] = slots, rb[first]
    lo = np.concatenate([[0], hi[:-1]])
    lo[np.cumsum(many + 1) - many - 1] = lb[first]
    size = hi - lo
    starts = np.cumsum(many + 1) - many - 1
    most = np.maximum.reduceat(size, starts)[group]
    largest = np.minimum.reduceat(np.where(size == most, np.arange(len(size)), len(size)), starts)
    small = np.ones(len(group), bool)
    small[largest] = False
    group, lo, hi = group[small], lo[small], hi[small]
    depth, left, right = length[first][group], lb[first][group], rb[first][group]
    found_at, found_period = [], []
    before = np.concatenate([[0], np.cumsum(hi - lo)])
    cuts = np.searchsorted(before, np.arange(0, before[-1], _CHUNK), side="right") - 1
    for s, e in zip(cuts, np.concatenate([cuts[1:], [len(lo)]])):
        slot, which = ranges(lo[s:e], hi[s:e])
        which += s
        i, d = sa.order[slot].astype(np.int64), depth[which]
        for other, place in ((i + d, i), (i - d, i - d)):
            ok = (other >= 0) & (other < sa.n)
            at = sa.slot[np.where(ok, other, 0)]
            ok &= (at >= left[which]) & (at < right[which]) & ~((at >= lo[which]) & (at < hi[which]))
            found_at.append(place[ok])
            found_period.append(d[ok])
    return np.concatenate(found_at), np.concatenate(found_period)


def runs_of(words: np.ndarray, bounds: np.ndarray, min_exponent: int = MIN_EXPONENT,
            min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs, by start and period; places count over all documents."""
    none = np.zeros(0, np.int64)
    if len(words) < 2:
        return none, none, none
    sa = SuffixArray(words, bounds)
    at, period = tandems(sa, min_exponent)
    start = at.copy()
    for level in reversed(range(len(sa.levels))):     # rotate: one word to the left while they agree
        back = start - (1 << level)
        go = np.flatnonzero(back >= 0)
        go = go[sa.same(level, back[go], back[go] + period[go])]
        start[go] = back[go]
    end = at + 2 * period
    on = end - start >= np.maximum(min_length, min_exponent * period)
    start, end, period = start[on], end[on], period[on]
    by = np.lexsort((period, end, start))
    start, end, period = start[by], end[by], period[by]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    by = np.lexsort((period, start))
    return start[by], end[by], period[by]


def _collapsed(buf: np.ndarray, begin: np.ndarray, stop: np.ndarray, kept: np.ndarray,
               at: np.ndarray) -> list[str]:
    """The kept words of each document (``at``: bounds in ``kept``), joined by one space."""
    size = stop[kept] - begin[kept] + 1                  # with the space after the word
    ends = np.concatenate([[0], np.cumsum(size)])
    out = np.empty(int(ends[-1]), np.uint8)
    for s in range(0, len(kept), _CHUNK // 8):
        own = kept[s:s + _CHUNK // 8]
        byte, _ = ranges(begin[own], begin[own] + size[s:s + _CHUNK // 8])
        part = buf[byte]
        part[ends[s + 1:s + 1 + len(own)] - ends[s] - 1] = 0x20
        out[ends[s]:ends[s] + len(part)] = part
    whole, cut = out.tobytes(), ends[at].tolist()
    return [whole[s:max(s, e - 1)].decode() for s, e in zip(cut, cut[1:])]


Rewrite = Callable[[object, int], "np.ndarray | None"]


def _block(ids: list, texts: list[str], rewrite: Rewrite | None, min_exponent: int, min_length: int):
    """Runs of each document, as (start, length, period) lists, and the collapsed texts."""
    raw = [t.encode() for t in texts]
    buf = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    silent = _SPACE[buf]
    edge = np.flatnonzero(silent[1:] != silent[:-1]) + 1
    begin = np.concatenate([np.zeros(0 if silent[0] else 1, np.int64), edge[~silent[edge]]])
    stop = edge[silent[edge]]
    bounds = np.searchsorted(begin, np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])]))
    words = hash_stretches(buf, begin, silent)
    source = np.arange(len(words))
    if rewrite is not None:
        for doc, s, e in zip(ids, bounds.tolist(), bounds[1:].tolist()):
            own = rewrite(doc, e - s)
            if own is not None:
                source[s:e] = own + s
        words = words[source]
    start, end, period = runs_of(words, bounds, min_exponent, min_length)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, end, -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    texts_left = _collapsed(buf, begin, stop, source[kept], np.searchsorted(kept, bounds))
    first = np.searchsorted(start, bounds)
    doc_of = np.searchsorted(bounds, start, side="right") - 1
    return first, start - bounds[doc_of], end - start, period, texts_left


def find(docs: DataFrame, rewrite: Rewrite | None = None, min_exponent: int = MIN_EXPONENT,
         min_length: int = MIN_LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, runs (start, length, period) by start and period, collapsed`` per input row.

    ``rewrite(doc_id, n)`` may give, for each of the ``n`` words of a document, the number of the word that
    stands there instead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            first, start, length, period, left = _block(b.column("doc_id").to_pylist(), texts_of(b), rewrite,
                                                        min_exponent, min_length)
            runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)],
                                              names=["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.ListArray.from_arrays(pa.array(first, pa.int32()), runs),
                 pa.array(left, pa.string())], names=["doc_id", "runs", "collapsed"])

    kind = dict(docs.dtypes)[id_col]
    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, f"doc_id {kind}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
