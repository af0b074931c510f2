"""Encode texts with a ``tokenizers`` model, asking it for each distinct piece once.

BPE merges never cross a pre-token.  Blocks of texts are cut, in numpy, at places that
are certain to begin a pre-token of the model's pattern; equal pieces then always have
equal ids, which a hash table of this worker remembers (64-bit hash of the piece; bounded
size).  Pieces with characters outside the plain classes below are simply not cut and go to
the library whole.
"""

from __future__ import annotations

import os
from collections.abc import Callable

import numpy as np

from orderlens.llm.byte_hash import hash_stretches

# Distinct pieces kept per worker, some 50 bytes each; the table starts anew beyond it (bounded memory, same ids).
MAX_PIECES = 600_000
# Text bytes encoded at once: longer texts are taken in parts.
PART_BYTES = 1 << 21

# Byte classes: only bytes that are certain to be a letter, a mark and so on.
OTHER, LETTER, MARK, DIGIT, SPACE, FEED, END = range(7)
END_BYTE = 0xFF                                   # never occurs in UTF-8; closes each text
_CLASS = np.zeros(256, np.uint8)
for _c in range(0x21, 0x7F):
    _CLASS[_c] = LETTER if chr(_c).isalpha() else DIGIT if chr(_c).isdigit() else MARK
_CLASS[ord("'")] = OTHER                          # may begin a contraction
_CLASS[ord(" ")], _CLASS[ord("\n")], _CLASS[END_BYTE] = SPACE, FEED, END
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def classes(buf: np.ndarray) -> np.ndarray:
    """The class of each byte; two-byte Latin letters (U+00C0 to U+017F) count as letters."""
    kind = _CLASS[buf]
    lead = np.flatnonzero((buf >= 0xC3) & (buf <= 0xC5))
    if len(lead):
        second = buf[lead + 1]
        # not the signs U+00D7 and U+00F7; U+0130 becomes two characters in lower case
        letter = lead[~((buf[lead] == 0xC3) & ((second == 0x97) | (second == 0xB7))
                        | (buf[lead] == 0xC4) & (second == 0xB0))]
        kind[letter] = LETTER
        kind[letter + 1] = LETTER
    return kind


def _next(x: np.ndarray, fill: int = END) -> np.ndarray:
    return np.concatenate([x[1:], [np.uint8(fill)]])


def _before(x: np.ndarray, fill: int = END) -> np.ndarray:
    return np.concatenate([[np.uint8(fill)], x[:-1]])


def _letters_against_marks(kind: np.ndarray, before: np.ndarray) -> np.ndarray:
    return ((kind == LETTER) & (before == MARK)) | ((kind == MARK) & (before == LETTER))


def spaced_cuts(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cuts for patterns in which a space belongs to the visible run after it.

    Such a space begins a pre-token whatever stands before it; letters and marks (without
    the apostrophe) never share one; a single line feed between visible bytes is one.
    """
    kind = classes(buf)
    before, after = _before(kind), _next(kind)
    visible_after = (after >= LETTER) & (after <= DIGIT)
    lone = (kind == FEED) & visible_after & (before >= LETTER) & (before <= DIGIT)
    cut = ((kind == SPACE) & visible_after) | _letters_against_marks(kind, before) | lone
    cut[1:] |= lone[:-1]
    return cut, np.zeros(0, bool)


def bare_cuts(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cuts for patterns that drop white space; spaces and line feeds are marked for dropping."""
    kind = classes(buf)
    before = _before(kind)
    white = (kind == SPACE) | (kind == FEED)
    white_before = (before == SPACE) | (before == FEED)
    return white | white_before | _letters_against_marks(kind, before), white


def short_parts(raw: bytes, most: int) -> list[bytes]:
    """A text in parts of about ``most`` bytes.  They are cut before a space between two plain letters or
    digits, where a pre-token certainly ends and the next one begins."""
    parts, start = [], 0
    while len(raw) - start > most:
        at = raw.find(b" ", start + most)
        while 0 <= at and not (raw[at - 1:at].isalnum() and raw[at + 1:at + 2].isalnum()):
            at = raw.find(b" ", at + 1)
        if at < 0:
            break
        parts.append(raw[start:at])
        start = at
    parts.append(raw[start:])
    return parts


class PieceCache:
    """``learn(pieces)`` gives the ids of distinct pieces: (all ids, how many each has)."""

    def __init__(self, learn: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]],
                 cuts: Callable, lower: bool = False):
        self.learn, self.cuts, self.lower = learn, cuts, lower
        self._clear()

    def _clear(self) -> None:
        self.count = 0
        self.keys, self.codes = np.zeros(1 << 17, np.uint64), np.zeros(1 << 17, np.int32)
        self.flat, self.used = np.empty(1 << 18, np.int32), 0
        self.start, self.length = np.empty(1 << 16, np.int32), np.empty(1 << 16, np.int32)

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Row of each hash, -1 where unknown (open addressing, one numpy pass per probe)."""
        mask = np.uint64(len(self.keys) - 1)
        at = (h & mask).astype(np.int64)
        seen = self.keys[at]
        found = np.where(seen == h, self.codes[at], -1)
        todo = np.flatnonzero((seen != h) & (seen != 0))
        while len(todo):
            at[todo] = (at[todo] + 1) & int(mask)
            seen = self.keys[at[todo]]
            hit = seen == h[todo]
            found[todo[hit]] = self.codes[at[todo[hit]]]
            todo = todo[~hit & (seen != 0)]
        return found

    def _insert(self, h: np.ndarray, codes: np.ndarray) -> None:
        mask = len(self.keys) - 1
        at = (h & np.uint64(mask)).astype(np.int64)
        todo = np.arange(len(h))
        while len(todo):
            free = todo[self.keys[at[todo]] == 0]
            self.keys[at[free]] = h[free]         # of several for one place the last stays
            placed = self.keys[at[todo]] == h[todo]
            self.codes[at[todo[placed]]] = codes[todo[placed]]
            todo = todo[~placed]
            at[todo] = (at[todo] + 1) & mask

    def _add(self, h: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        n, k = len(h), self.count
        while (k + n) * 3 > len(self.keys) * 2:
            old = self.keys != 0
            keys, codes = self.keys[old], self.codes[old]
            size = len(self.keys) * 2
            self.keys, self.codes = np.zeros(size, np.uint64), np.zeros(size, np.int32)
            self._insert(keys, codes)
        while k + n > len(self.start):
            self.start = np.concatenate([self.start, np.empty_like(self.start)])
            self.length = np.concatenate([self.length, np.empty_like(self.length)])
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        self.flat[self.used:self.used + len(ids)] = ids
        self.start[k:k + n] = self.used + np.cumsum(lengths) - lengths
        self.length[k:k + n] = lengths
        self._insert(h, np.arange(k, k + n, dtype=np.int32))
        self.count, self.used = k + n, self.used + len(ids)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the ``len(texts) + 1`` bounds of the texts in them."""
        raw = [t.encode() for t in texts]
        if sum(map(len, raw)) <= PART_BYTES:
            return self._encode(raw)
        found, counts = [], np.zeros(len(raw), np.int64)
        group, owner, size = [], [], 0
        for k, text in enumerate(raw):
            for part in short_parts(text, PART_BYTES):
                if group and size + len(part) > PART_BYTES:
                    self._encode_into(found, counts, group, owner)
                    group, owner, size = [], [], 0
                group.append(part)
                owner.append(k)
                size += len(part)
        if group:
            self._encode_into(found, counts, group, owner)
        return (np.concatenate(found) if found else np.empty(0, np.int32)), np.concatenate([[0], np.cumsum(counts)])

    def _encode_into(self, found: list, counts: np.ndarray, parts: list[bytes], owner: list[int]) -> None:
        ids, bounds = self._encode(parts)
        found.append(ids)
        np.add.at(counts, owner, np.diff(bounds))

    def _encode(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if self.count > MAX_PIECES or self.used > 8 * MAX_PIECES:
            self._clear()
        end = bytes([END_BYTE])
        buf = np.frombuffer(end.join(raw) + end, np.uint8)
        if self.lower:
            buf = _LOWER[buf]
        cut, white = self.cuts(buf)
        ends = buf == END_BYTE
        cut |= ends
        cut[1:] |= ends[:-1]
        cut[0] = True
        starts = np.flatnonzero(cut)
        keep = ~ends[starts]
        if len(white):
            keep &= ~white[starts]
        h = hash_stretches(buf, starts)
        stops = np.concatenate([starts[1:], [len(buf)]])[keep]
        starts, h = starts[keep], h[keep]
        h[h == 0] = 1
        codes = self._find(h)
        unknown = np.flatnonzero(codes < 0)
        if len(unknown):
            new, first = np.unique(h[unknown], return_index=True)
            first = unknown[first]
            whole = buf.tobytes()
            ids, lengths = self.learn([whole[s:e] for s, e in zip(starts[first].tolist(),
                                                                  stops[first].tolist())])
            self._add(new, ids, lengths)
            codes[unknown] = self._find(h[unknown])
        ids, ends_of = gather(self.flat, self.start[codes].astype(np.int64), self.length[codes].astype(np.int64))
        sizes = np.array([len(r) + 1 for r in raw], np.int64)
        pieces_before = np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)]))
        return ids, np.concatenate([[0], ends_of])[pieces_before]


def gather(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slices ``flat[start:start + length]`` one after the other, and where each one ends."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    step = np.repeat(start - (ends - length), length)
    step += np.arange(total)
    return flat[step], ends


def plain_runs(pieces: list[bytes]) -> np.ndarray:
    """Pieces that are only letters or only marks."""
    if not pieces:
        return np.zeros(0, bool)
    buf = np.frombuffer(b"\xff".join(pieces) + b"\xff", np.uint8)
    kind = classes(buf)
    size = np.array([len(p) + 1 for p in pieces])
    starts = np.cumsum(size) - size
    count = lambda k: np.add.reduceat((kind == k).astype(np.int64), starts)
    return (count(LETTER) == size - 1) | (count(MARK) == size - 1)


def learn_with(model, joined: Callable[[list[bytes]], np.ndarray], separator: str,
               piece_of_token: Callable[[np.ndarray, list[bytes]], np.ndarray]):
    """The ``learn`` function of a ``tokenizers`` model.

    Pieces that ``joined`` marks are sent as one text per thousand, put together with
    ``separator``; ``piece_of_token`` tells how many tokens each of them has.  The others are sent
    one by one.
    """

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")   # tasks already use all cores

    def learn(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        mark = joined(pieces)
        ids_of: list[np.ndarray] = [np.empty(0, np.int32)] * len(pieces)
        plain = np.flatnonzero(mark).tolist()
        for lo in range(0, len(plain), 1000):
            own = plain[lo:lo + 1000]
            raw = [pieces[i] for i in own]
            found = model.encode_batch_fast([separator.join(r.decode() for r in raw)],
                                            add_special_tokens=False)[0].ids
            ids = np.asarray(found, np.int32)
            lengths = piece_of_token(ids, raw)
            if lengths.sum() != len(ids) or len(lengths) != len(own):
                raise AssertionError("pieces and tokens do not agree")
            for i, x in zip(own, np.split(ids, np.cumsum(lengths)[:-1])):
                ids_of[i] = x
        rest = np.flatnonzero(~mark).tolist()
        for i, e in zip(rest, model.encode_batch_fast([pieces[i].decode() for i in rest],
                                                      add_special_tokens=False)):
            ids_of[i] = np.asarray(e.ids, np.int32)
        return np.concatenate(ids_of), np.array([len(x) for x in ids_of], np.int64)

    return learn
