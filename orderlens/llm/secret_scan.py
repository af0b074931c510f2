"""Operator 3: secret scan.  Three base patterns, and sliding-window Shannon entropy per
character class over candidate strings, with an allow-list.

A candidate is a run of 20 or more characters of ``[A-Za-z0-9+/_=-]``.  Its class is ``hex``
(only ``[0-9a-f]`` or ``[0-9A-F]``) or ``base64``.  A window of ``WINDOW`` characters slides over
it; the sum of ``c * log2(c)`` over the character counts is updated for the character that
enters and the one that leaves, so each step costs the same whatever the window.  Windows that
reach the entropy of their class and mix letters and digits are united to spans of kind
``entropy_hex`` or ``entropy_base64``.  The allow-list is matched against the parts of a candidate between
``=`` and ``/``; what is left beside a matched part is scanned as a candidate of its own.  Base spans
always stay.

Cases: null and empty texts have no spans; texts of any length are scanned whole; repeated rows get
equal results; an empty table gives an empty result; other columns are not read.  Positions count
code points, the end is exclusive.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

from orderlens.llm.common import blocks, id_and_text, texts_of

# Fixed patterns and least lengths of the base kinds, in their order.
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WINDOW = 20
LEAST_BITS = {"hex": 3.0, "base64": 3.7}
# Candidates that look random but are none: placeholders, repeated letters, separators of tables.
ALLOW = (r"(?i).*(example|placeholder|changeme|your[-_]?(key|token|secret)|dummy|lorem).*",
         r"[xX*0=_-]+", r"(?i)[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}")
PART = re.compile(r"[^=/]+")
# Shorter parts are not matched: a random string can hold "/x/" or "=0/".
LEAST_PART = 4

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind that are long enough."""
    out: list[Span] = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return out


_PLAIN = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]


def entropy_runs(s: str, least: float, window: int = WINDOW) -> list[tuple[int, int]]:
    """United windows of ``s`` with at least ``least`` bits that hold letters and digits."""
    counts: dict[str, int] = {}
    total, digits, letters, out = 0.0, 0, 0, []
    weight = _PLAIN if window == WINDOW else [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    whole = math.log2(window)
    for i, c in enumerate(s):
        n = counts.get(c, 0)
        total += weight[n + 1] - weight[n]
        counts[c] = n + 1
        digits += c.isdigit()
        letters += c.isalpha()
        if i >= window:
            o = s[i - window]
            n = counts[o]
            total += weight[n - 1] - weight[n]
            counts[o] = n - 1
            digits -= o.isdigit()
            letters -= o.isalpha()
        if i >= window - 1 and digits and letters and whole - total / window >= least:
            start = i - window + 1
            if out and out[-1][1] >= start:
                out[-1] = (out[-1][0], i + 1)
            else:
                out.append((start, i + 1))
    return out


def _kind(s: str) -> str:
    return "hex" if not s.strip("0123456789abcdef") or not s.strip("0123456789ABCDEF") else "base64"


def _beside_allowed(s: str, allow: Sequence[re.Pattern]) -> list[tuple[int, int]]:
    """The stretches of a candidate without the parts that the allow-list matches."""
    out, at = [], 0
    for p in PART.finditer(s):
        if len(p[0]) >= LEAST_PART and any(a.fullmatch(p[0]) for a in allow):
            out.append((at, p.start()))
            at = p.end() + 1
    return [*out, (at, len(s))]


def entropy_spans(text: str, allow: Sequence[re.Pattern]) -> list[Span]:
    out: list[Span] = []
    for m in CANDIDATE.finditer(text):
        s = m[0]
        if s.isalpha() and (s.islower() or s.istitle()):        # a long word
            continue
        kind = _kind(s)
        runs = entropy_runs(s, LEAST_BITS[kind])
        if not runs:
            continue
        stretches = _beside_allowed(s, allow)
        if len(stretches) == 1:
            out += [(f"entropy_{kind}", m.start() + a, m.start() + b) for a, b in runs]
            continue
        for lo, hi in stretches:
            kind = _kind(s[lo:hi])
            out += [(f"entropy_{kind}", m.start() + lo + a, m.start() + lo + b)
                    for a, b in entropy_runs(s[lo:hi], LEAST_BITS[kind])]
    return out


def joined(spans: Iterable[Span]) -> str:
    ordered = sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))
    return ",".join(f"{k}:{s}:{e}" for k, s, e in ordered)


def scan(docs: DataFrame, allow: Sequence[str] = ALLOW, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy`` per input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [re.compile(a) for a in allow]
        for b in blocks(batches):
            rows = []
            for t in texts_of(b):
                base = base_spans(t)
                more = entropy_spans(t, patterns)
                kinds = [k for k, _, _ in base]
                rows.append((kinds.count("assign"), kinds.count("access"), kinds.count("hex"),
                             hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + more), len(more)))
            cols = list(zip(*rows))
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_entropy"])

    kind = dict(docs.dtypes)[id_col]
    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, "
             "spans string, n_entropy bigint")
