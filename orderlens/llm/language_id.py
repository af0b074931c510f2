"""Operator 7: language identification by compression.

Each language has a zstandard raw-content dictionary of sampled texts.  A text, reduced to its
lower-case words, is encoded once per language in pieces of ``PIECE`` bytes that cover it whole; the
language whose dictionary gives the fewest bytes in total wins.  A text is rejected when the second
language needs hardly more, or when the first needs more than its texts of that size do.  Both limits
are calibrated per language and size: dictionaries of every other learning piece classify
beginnings of the rest, and quantiles of the right predictions, with some slack, are the limits.
A language with fewer than ``LEAST_RIGHT`` of them at a size takes the widest limits that the others have there.
Below about 25 bytes compressed sizes are equal, so there is no limit.

The dictionaries are fitted on a bounded sample of all labelled rows: ``DICT_BYTES`` of text per
language, where a text of more than ``SAMPLE_TEXT`` bytes counts as pieces of a quarter as many characters,
and ``MAX_LANGUAGES`` languages at most (more raise an error).  Only they are broadcast.

Letters are the characters of Unicode's letter classes; digits and other numbers are none.

Cases: null texts and texts without a letter are ``und`` with score 0 and rejected; ties go to the
language with more learning text, then the first in alphabetical order; without any labelled row all are ``und``; repeated rows get
equal results; other columns are not read by a prediction.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import blocks, held_out, id_and_text, materialise, texts_of

DICT_BYTES = 192 << 10
SAMPLE_TEXT = 16 << 10
MAX_LANGUAGES = 200
PIECE = 2048
LEVEL = 6
# Rejection: sizes (reduced bytes) that are calibrated, texts per language, right predictions that a
# limit needs, share of them beyond it, slack of margin and of bytes.
SIZES = (25, 50, 100, 200, 400, 800, 1600, 3200)
CALIBRATED, LEAST_RIGHT, BEYOND = 200, 20, 0.005
MARGIN_SLACK, BYTES_SLACK = 0.5, 1.12
UNKNOWN = "und"


class Profile(NamedTuple):
    """Languages, those with more learning text first, their dictionaries, and for each language the
    limits ``(size, least margin, most compressed bytes per byte)`` by rising size."""
    languages: tuple[str, ...]
    contents: tuple[bytes, ...]
    limits: tuple[tuple[tuple[int, float, float], ...], ...] = ()


_BREAK = re.compile(r"[\W\d_]+")


def reduced(text: str) -> bytes:
    """The words (runs of letters) of a text in lower case, joined by one space, as UTF-8."""
    words = _BREAK.sub(" ", text.lower()).strip(" ")
    if not words.replace(" ", "").isalpha():         # characters like \u00b2 or \u00bd count as word characters there
        words = " ".join("".join(c if c.isalpha() else " " for c in words).split(" "))
        words = re.sub(" +", " ", words).strip(" ")
    return words.encode()


def fit(docs: DataFrame, learn: Column | None = None, lang_col: str = "lang", id_col: str = "doc_id",
        text_col: str = "text") -> Profile:
    """Dictionaries from the rows that ``learn`` admits (default: rows that are not held out)."""
    learn = ~held_out(id_col) if learn is None else learn
    rows = (docs.filter(learn & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
            .select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"),
                    F.xxhash64(F.col(id_col), F.col(text_col)).alias("h")))
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("n"))
             .limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return Profile((), ())
    # a hash threshold per language keeps about twice the bytes a dictionary takes
    limit = F.lit(None).cast("bigint")
    for lang, n in sizes.items():
        share = min(1.0, 2.0 * DICT_BYTES / max(n, 1))
        limit = F.when(F.col("lang") == lang, F.lit(int(share * (1 << 31)))).otherwise(limit)
    # pieces of long texts are picked one by one, each by a hash of its own
    size, long = SAMPLE_TEXT // 4, F.octet_length("text") > SAMPLE_TEXT
    own = lambda k: F.when(k == 0, F.col("h")).otherwise(F.xxhash64("h", k))
    last = F.when(long, F.floor((F.length("text") - 1) / size)).otherwise(0).cast("int")
    pieces = F.filter(F.sequence(F.lit(0), last), lambda k: F.pmod(own(k), F.lit(1 << 31)) < F.col("limit"))
    picked = (rows.withColumn("limit", limit).select("lang", "text", "h", F.explode(pieces).alias("k"))
              .select("lang", own(F.col("k")).alias("h"),
                      F.when(long, F.substring("text", F.col("k") * size + 1, F.lit(size))).otherwise(F.col("text"))
                      .alias("text")))
    picked = materialise(picked, "language_pieces")
    texts: dict[str, list[tuple[bytes, bool]]] = {lang: [] for lang in sizes}
    for r in sorted(picked.collect(), key=lambda r: (r.h, r.text)):
        if raw := reduced(r.text):
            texts[r.lang].append((raw, r.h % 2 == 0))
    langs = tuple(sorted((lang for lang, t in texts.items() if t), key=lambda x: (-sizes[x], x)))
    # half of the pieces classify the other half, which the tasks read from the table
    half = Profile(langs, tuple(_content([raw for raw, first in texts[lang] if first]) for lang in langs))
    limits = _calibrate(picked.filter(F.pmod("h", F.lit(2)) == 1), half)
    return Profile(langs, tuple(_content([raw for raw, _ in texts[lang]]) for lang in langs), limits)


def _content(texts: list[bytes]) -> bytes:
    """A dictionary of the texts; it has 8 bytes at least, so less text is repeated."""
    out = b""
    for raw in texts:
        if len(out) < DICT_BYTES:
            out += raw + b"\n"
    return (out * (8 if len(out) < 8 else 1))[:DICT_BYTES]


def _calibrate(pieces: DataFrame, half: Profile) -> tuple:
    """The limits of each language from ``pieces (lang, h, text)`` that are not in the dictionaries of ``half``."""
    number = {lang: k for k, lang in enumerate(half.languages)}
    sent = pieces.sparkSession.sparkContext.broadcast(tuple(half))
    first = Window.partitionBy("lang").orderBy("h", "text")       # a bounded sample per language
    cases = (pieces.withColumn("at", F.row_number().over(first)).filter(F.col("at") <= CALIBRATED)
             .select("lang", "text").repartition(64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = _compressors(Profile(*sent.value))
        for b in batches:
            right = []
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                raw = reduced(text)
                for n in SIZES:
                    if len(raw) >= n and lang in number:
                        best, margin, share = _measure(raw[:n], compressors)
                        if best == number[lang]:
                            right.append((best, n, margin, share))
            if right:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*right)], names=["k", "n", "margin", "share"])

    def beyond(c: str, rising: bool) -> Column:
        """The value of ``c`` that a share of ``BEYOND`` lies beyond."""
        return F.get(F.sort_array(F.collect_list(c), rising), F.floor(BEYOND * F.count("*")).cast("int"))

    own = {(r.k, r.n): (r.n, MARGIN_SLACK * r.margin, BYTES_SLACK * r.share) for r in
           cases.mapInArrow(run, "k bigint, n bigint, margin double, share double").groupBy("k", "n")
           .agg(F.count("*").alias("right"), beyond("margin", True).alias("margin"), beyond("share", False).alias("share"))
           .filter(F.col("right") >= LEAST_RIGHT).collect()}
    sent.unpersist()
    widest = {}
    for n in SIZES:
        here = [x for (_, size), x in own.items() if size == n]
        if here:
            widest[n] = (n, min(x[1] for x in here), max(x[2] for x in here))
    return tuple(tuple(own.get((k, n), widest[n]) for n in SIZES if n in widest) for k in range(len(half.languages)))


def _compressors(profile: Profile) -> list[zstandard.ZstdCompressor]:
    out = []
    for content in profile.contents:
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=LEVEL)
        out.append(zstandard.ZstdCompressor(dict_data=d, level=LEVEL, write_content_size=False,
                                            write_checksum=False, write_dict_id=False))
    return out


def _measure(raw: bytes, compressors: list) -> tuple[int, float, float]:
    """The best compressor, the share of bytes that the second needs more, compressed bytes per byte."""
    pieces = [raw[i:i + PIECE] for i in range(0, len(raw), PIECE)]
    sizes = sorted((sum(len(c.compress(p)) for p in pieces), k) for k, c in enumerate(compressors))
    best, k = sizes[0]
    return k, sizes[1][0] / best - 1 if len(sizes) > 1 else 1.0, best / len(raw)


def classify(text: str, profile: Profile, compressors: list) -> tuple[str, float, bool]:
    """Language, score (share of bytes that the second language needs more, 0 to 1), rejected."""
    raw = reduced(text)
    if not compressors or not raw:
        return UNKNOWN, 0.0, True
    k, margin, share = _measure(raw, compressors)
    least, most = limits_at(len(raw), profile.limits[k] if profile.limits else ())
    return profile.languages[k], min(1.0, max(0.0, margin)), margin < least or share > most


def limits_at(size: int, limits: tuple) -> tuple[float, float]:
    """Least margin and most compressed bytes per byte at a size: between two calibrated sizes by the logarithm of the size."""
    below = [x for x in limits if x[0] <= size]
    if not below:
        return 0.0, math.inf
    low, least, most = below[-1]
    above = limits[len(below):]
    if not above:
        return least, most
    t = math.log(size / low) / math.log(above[0][0] / low)
    return least + t * (above[0][1] - least), most + t * (above[0][2] - most)


def _broadcast(docs: DataFrame, profile: Profile):
    return docs.sparkSession.sparkContext.broadcast(tuple(profile))


def predict(docs: DataFrame, profile: Profile, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` per input row."""
    sent = _broadcast(docs, profile)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Profile(*sent.value)
        compressors = _compressors(own)
        for b in blocks(batches):
            rows = [classify(t, own, compressors) for t in texts_of(b)]
            lang, score, rejected = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(lang, pa.string()),
                 pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                names=["doc_id", "held_out", "lang_pred", "score", "rejected"])

    kind = dict(docs.dtypes)[id_col]
    return (id_and_text(docs, id_col, text_col).select("doc_id", held_out().alias("held_out"), "text")
            .mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, rejected boolean"))


def keep_identified(docs: DataFrame, profile: Profile, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose language is not rejected."""
    sent = _broadcast(docs, profile)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Profile(*sent.value)
        compressors = _compressors(own)
        for b in blocks(batches, text_col):
            keep = [not classify(t, own, compressors)[2] for t in texts_of(b, text_col)]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
