"""Operator 1: byte-level BPE encoding and decoding.

``encode`` gives the ids of the ``tokenizers`` library over Arrow batches, with
byte and character offsets from the table of each token's bytes; ``decode``
reverses the byte table.  A character whose bytes are split over several tokens
is put together again because decoding joins bytes before it reads characters.

Cases: null and empty texts give no tokens; repeated rows give repeated results;
an empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from orderlens.llm.common import blocks, id_and_text, texts_of
from orderlens.llm.piece_cache import PieceCache, gather, learn_with, plain_runs, spaced_cuts

VOCABULARY = "byte_bpe_50k.json"
# Ids that are digested together; blocks of more are digested document by document in such parts.
DIGEST_IDS = 1 << 18


def byte_alphabet() -> dict[str, int]:
    """Printable character -> byte, as byte-level vocabularies write their tokens:
    visible Latin-1 bytes stand for themselves, the others for 256, 257, ..."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """One vocabulary file with its encoder cache and its table of token bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        model = Tokenizer.from_file(path)
        model.encode_special_tokens = True        # their strings in a text are ordinary text
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        table, tokens = byte_alphabet(), [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            if all(c in table for c in token):
                tokens[i] = bytes(table[c] for c in token)
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.name = [str(i) for i in range(len(tokens))]
        self.cache = PieceCache(learn_with(model, self._space_and_letters, "", self._by_bytes), spaced_cuts)

    def _space_and_letters(self, pieces: list[bytes]) -> np.ndarray:
        """Pieces of a space and then plain letters: put together they fall apart again."""
        spaced = np.array([p[:1] == b" " and len(p) > 1 for p in pieces], bool)
        letters = plain_runs([p[1:] if s else b"." for p, s in zip(pieces, spaced)])
        return spaced & letters & np.array([p[1:2].isalpha() or p[1:2] >= b"\xc3" for p in pieces], bool)

    def _by_bytes(self, ids: np.ndarray, pieces: list[bytes]) -> np.ndarray:
        ends = np.searchsorted(np.cumsum(self.size[ids]), np.cumsum([len(p) for p in pieces])) + 1
        return np.diff(ends, prepend=0)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.cache.encode(texts)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all tokens and where each token ends in them."""
        return gather(self.bytes, self.start[ids], self.size[ids])


_MODELS: dict[str, ByteBpe] = {}


def model(path: str) -> ByteBpe:
    """The model of this worker (loaded once per process)."""
    if path not in _MODELS:
        _MODELS[path] = ByteBpe(path)
    return _MODELS[path]


def _vocabulary(path: str | None) -> str:
    return path or public_tokenizers.path(VOCABULARY)


def encode(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``doc_id, ids, byte_start, char_start``: token ids with the byte and the character
    at which each token begins (a token inside a character begins at that character)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(_vocabulary(vocabulary))
        for b in blocks(batches):
            texts = texts_of(b)
            ids, at = m.encode(texts)
            raw, ends = m.decode(ids)
            begin = ends - m.size[ids]
            # character number of each byte: continuation bytes belong to the one before
            char = np.cumsum((raw & 0xC0) != 0x80) - 1
            out = []
            for i in range(len(texts)):
                s, e = at[i], at[i + 1]
                first = begin[s] if e > s else 0
                out.append((ids[s:e], begin[s:e] - first,
                            char[begin[s:e]] - char[first] if e > s else begin[s:e]))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([x[0].astype(np.int32) for x in out], pa.list_(pa.int32())),
                 *(pa.array([x[k].astype(np.int64) for x in out], pa.list_(pa.int64())) for k in (1, 2))],
                names=["doc_id", "ids", "byte_start", "char_start"])

    kind = dict(docs.dtypes)[id_col]
    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, f"doc_id {kind}, ids array<int>, byte_start array<bigint>, char_start array<bigint>")


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; bytes that form no character become U+FFFD."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(_vocabulary(vocabulary))
        for b in batches:
            texts = [m.decode(np.asarray(x or [], np.int64))[0].tobytes().decode("utf-8", "replace")
                     for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])

    kind = dict(encoded.dtypes)["doc_id"]
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def _digests(m: ByteBpe, ids: np.ndarray) -> tuple[str, str, int]:
    """Digests of the ids and of the decoded bytes of one document, and its tokens that begin inside a character."""
    names, decoded, inside = hashlib.sha256(), hashlib.sha256(), 0
    for s in range(0, len(ids), DIGEST_IDS):
        part = ids[s:s + DIGEST_IDS]
        names.update(((" " if s else "") + " ".join(map(m.name.__getitem__, part.tolist()))).encode())
        raw, ends = m.decode(part)
        decoded.update(raw)
        inside += int(np.count_nonzero((raw[ends - m.size[part]] & 0xC0) == 0x80))
    return names.hexdigest(), decoded.hexdigest(), inside


def round_trip(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, n_split_chars``: digests of the ids and
    of the bytes decoded from them, and the tokens that begin inside a character."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(_vocabulary(vocabulary))
        for b in blocks(batches):
            ids, at = m.encode(texts_of(b))
            bounds = at.tolist()
            if len(ids) > 4 * DIGEST_IDS:
                digest, decoded, split = zip(*(_digests(m, ids[s:e]) for s, e in zip(bounds, bounds[1:])))
            else:
                raw, ends = m.decode(ids)
                byte_at = np.concatenate([[0], ends])[at].tolist()
                begin = ends - m.size[ids]
                split = np.diff(np.concatenate([[0], np.cumsum((raw[begin] & 0xC0) == 0x80)])[at])
                names = list(map(m.name.__getitem__, ids.tolist()))
                raw = raw.tobytes()
                digest = [hashlib.sha256(" ".join(names[s:e]).encode()).hexdigest()
                          for s, e in zip(bounds, bounds[1:])]
                decoded = [hashlib.sha256(raw[s:e]).hexdigest() for s, e in zip(byte_at, byte_at[1:])]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.diff(at)), pa.array(digest, pa.string()),
                 pa.array(decoded, pa.string()), pa.array(split, pa.int64())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_split_chars"])

    kind = dict(docs.dtypes)[id_col]
    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, n_split_chars bigint")
