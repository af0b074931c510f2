"""Operator 8: deletion of repeated line runs by a distributed suffix array.

The corpus is read as sequences of line ids (non-blank lines of a document, in order).  Lines that
occur once anywhere end a run, so only stretches of repeated lines with ``MIN_WORDS`` words
enter the suffix array.

* Prefix doubling: ``r0`` is the line id; ``r(k+1)`` is the rank of ``(rk at p, rk at p + 2**k)`` among all
  such pairs, from one distributed sort of the distinct pairs.  After level k suffixes are sorted
  by their first ``2**k`` lines, and suffixes of one rank form a longest-common-prefix interval of
  at least that depth.  Doubling ends when the depth passes the longest prefix that is asked for.
* A run of enough words is the union of its shortest windows of ``MIN_WORDS`` words: a line whose run holds
  enough words up to it is in the window that ends there, any other in the window that begins with
  the run.  So each place has two windows, the shortest that begins and the shortest that ends there,
  and longer agreements need no deeper ranks.  A window of ``m`` lines from ``p`` is named by two
  overlapping ranks, at ``p`` and at ``p + m - 2**k``.
* A window whose name has an earlier place (least document id, then line) is deleted.  All
  earlier places count, as each window of a run is looked up on its own.

So a line goes exactly if it lies in a run of at least ``MIN_WORDS`` words that also begins earlier.
The earliest copy of any line always stays somewhere.

Cases: null text stays null and empty text empty; blank lines are never counted or deleted and do not
break a run; overlapping copies inside one document keep the first; repeated rows (same id and text)
count as one document and get the same result; an empty table gives an empty result; other columns
are kept by ``clean`` and not read otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import blocks, fresh, id_and_text, materialise

MIN_WORDS = 50
WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = r"[\x20\x09-\x0D]+"
# Documents with deletions that are broadcast at most, with their line numbers.
BROADCAST_LINES = 4_000_000
_DOC = ["doc_id", "th"]


def _key() -> Column:
    """Order of occurrence."""
    return F.struct(F.col("doc_id").alias("doc_id"), F.col("th").alias("th"), F.col("j").alias("j"))


def line_table(docs: DataFrame) -> DataFrame:
    """``doc_id, th, j, i, h, wc``: non-blank lines with their place ``j`` among them and ``i`` among all."""
    trimmed = lambda x: F.btrim(x, F.lit(WHITE))
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct(
        i.alias("i"), F.xxhash64(x).alias("h"),
        F.when(trimmed(x) == "", 0).otherwise(F.size(F.split(trimmed(x), WHITE_RUN))).alias("wc")))
    return (docs.select("doc_id", F.xxhash64("text").alias("th"), lines.alias("ls"))
            .select(*_DOC, F.posexplode(F.filter("ls", lambda s: s.wc > 0)).alias("j", "s"))
            .select(*_DOC, "j", "s.i", "s.h", "s.wc").dropDuplicates([*_DOC, "j"]))


def _repeated(lines: DataFrame, min_words: int) -> DataFrame:
    """Lines of stretches of repeated lines with enough words: ``..., seg, m``, ``back``: lines of the
    shortest windows with enough words that begin and that end there (null: none)."""
    # written first, so that the join is between plain tables and a hot line can be split
    again = materialise(lines.groupBy("h").agg(F.count("*").alias("k")).filter("k > 1").select("h"), "line_ids")
    inside = lines.join(again, "h")
    by_doc = Window.partitionBy(*_DOC).orderBy("j")
    seg = Window.partitionBy(*_DOC, "seg")
    rows = (inside.withColumn("seg", F.col("j") - F.row_number().over(by_doc))
            .withColumn("seg_words", F.sum("wc").over(seg)).filter(F.col("seg_words") >= min_words)
            .withColumn("c0", F.sum("wc").over(seg.orderBy("j")) - F.col("wc")))
    reach = seg.orderBy("c0").rangeBetween(min_words, Window.unboundedFollowing)
    behind = seg.orderBy("c1").rangeBetween(Window.unboundedPreceding, -min_words)
    last = F.max("j").over(seg) + 1
    return (rows.withColumn("c1", F.col("c0") + F.col("wc"))
            .withColumn("stop", F.coalesce(
                F.min("j").over(reach), F.when(F.col("seg_words") - F.col("c0") >= min_words, last)))
            .withColumn("start", F.coalesce(
                F.max("j").over(behind) + 1, F.when(F.col("c1") >= min_words, F.min("j").over(seg))))
            .withColumn("m", (F.col("stop") - F.col("j")).cast("int"))
            .withColumn("back", (F.col("j") + 1 - F.col("start")).cast("int"))
            .select(*_DOC, "seg", "j", "i", "h", "m", "back"))


def _ranks(pairs: DataFrame) -> DataFrame:
    """``a, b, rank`` for distinct pairs: their places in sorted order, numbered by partition."""
    rows = materialise(pairs.orderBy("a", F.col("b").asc_nulls_first())
                       .withColumn("at", F.monotonically_increasing_id()), "line_ranks")
    part = F.shiftright("at", 33)
    # one row per partition
    before = (rows.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
              .select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base")))
    return (rows.join(F.broadcast(before), part == F.col("part"))
            .select("a", "b", (F.col("base") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).alias("rank")))


def suffix_ranks(rows: DataFrame, depth: int) -> tuple[DataFrame, int]:
    """``rows`` with ``r0 .. rK``, ranks by the first ``2**k`` lines; ``2**K`` is at most ``depth``."""
    rows = rows.withColumn("r0", F.col("h"))
    order = Window.partitionBy(*_DOC, "seg").orderBy("j")
    k = 0
    while 2 << k <= depth:
        rows = materialise(rows.withColumn("b", F.lead(f"r{k}", 1 << k).over(order)), "line_suffixes")
        ranks = _ranks(rows.select(F.col(f"r{k}").alias("a"), "b").distinct())
        rows = (rows.join(ranks.withColumnRenamed("b", "rb"),
                          (F.col(f"r{k}") == F.col("a")) & F.col("b").eqNullSafe(F.col("rb")))
                .withColumn(f"r{k + 1}", F.col("rank")).drop("a", "b", "rb", "rank"))
        k += 1
    return materialise(rows, "line_suffixes"), k


def _at_level(names: list[str], m: Column) -> Column:
    """The rank of the largest level that fits into ``m`` lines."""
    out = F.col(names[0])
    for k, name in enumerate(names[1:], 1):
        out = F.when(m >= (1 << k), F.col(name)).otherwise(out)
    return out


def _power(m: Column, levels: int) -> Column:
    out = F.lit(1)
    for k in range(1, levels + 1):
        out = F.when(m >= (1 << k), F.lit(1 << k)).otherwise(out)
    return out


def deletions(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, th, gone``: sorted numbers of the lines to delete, of documents that lose any."""
    lines = materialise(line_table(docs), "line_table")
    rows = materialise(_repeated(lines, min_words), "repeated_lines")
    depth = rows.agg(F.max(F.greatest("m", "back"))).first()[0] or 0
    rows, levels = suffix_ranks(rows, depth)
    ranks = [f"r{k}" for k in range(levels + 1)]
    m = F.col("m")
    order = Window.partitionBy(*_DOC, "seg").orderBy("j")
    # ranks of the 2**k lines that end at a place
    ended = rows.select(*_DOC, "seg", "j", F.col("back").alias("m"),
                        *[F.lag(r, (1 << k) - 1).over(order).alias(r) for k, r in enumerate(ranks)])
    windows = (rows.filter("m is not null")
               .select(*_DOC, "seg", "j", "m", _at_level(ranks, m).alias("own"),
                       (F.col("j") + m - _power(m, levels)).alias("at"), F.lit(True).alias("begins"))
               .unionByName(ended.filter("m is not null")
                            .select(*_DOC, "seg", (F.col("j") + 1 - m).alias("j"), "m", _at_level(ranks, m).alias("own"),
                                    (F.col("j") + 1 - m).alias("at"), F.lit(False).alias("begins"))))
    second = rows.select(*[F.col(c).alias(f"q_{c}") for c in [*_DOC, "j", *ranks]])
    other = _at_level([f"q_{r}" for r in ranks], m)
    named = (windows.join(second, F.col("doc_id").eqNullSafe(F.col("q_doc_id")) & (F.col("th") == F.col("q_th"))
                          & (F.col("q_j") == F.col("at")))
             .select(*_DOC, "seg", "j", "m", F.when(F.col("begins"), F.col("own")).otherwise(other).alias("a"),
                     F.when(F.col("begins"), other).otherwise(F.col("own")).alias("b")))
    named = materialise(named, "line_intervals")
    firsts = materialise(named.groupBy("m", "a", "b")
                         .agg(F.min(_key()).alias("first"), F.max(_key()).alias("last"))
                         .filter(~F.col("first").eqNullSafe(F.col("last"))).drop("last"), "line_firsts")
    later = (named.join(firsts, ["m", "a", "b"]).filter(~_key().eqNullSafe(F.col("first")))
             .select(*_DOC, "seg", "j", F.lit(None).cast("int").alias("i"), (F.col("j") + m).alias("stop")))
    # a line goes if a window that begins there or before ends after it
    both = rows.select(*_DOC, "seg", "j", "i", F.lit(None).cast("int").alias("stop")).unionByName(later)
    reached = both.withColumn("reach", F.max("stop").over(order))
    return (reached.filter(F.col("i").isNotNull() & (F.col("reach") > F.col("j")))
            .groupBy(*_DOC).agg(F.array_sort(F.collect_set("i")).alias("gone")))


def _joined(docs: DataFrame, min_words: int, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    """``docs`` with the numbers of the lines to delete in a new column (null: none)."""
    gone = materialise(deletions(id_and_text(docs, id_col, text_col), min_words), "line_deletions")
    size = gone.agg(F.sum(F.size("gone") + 2)).first()[0] or 0
    out, d, t, own = (fresh(docs, x) for x in ("gone_lines", "gone_doc", "gone_hash", "text_hash"))
    right = gone.select(F.col("doc_id").alias(d), F.col("th").alias(t), F.col("gone").alias(out))
    right = F.broadcast(right) if size <= BROADCAST_LINES else right
    return (docs.withColumn(own, F.xxhash64(F.col(text_col)))
            .join(right, F.col(id_col).eqNullSafe(F.col(d)) & (F.col(own) == F.col(t)), "left")
            .drop(own, d, t)), out


def _cut(batch: pa.RecordBatch, text_col: str, gone_col: str) -> list[str | None]:
    out = []
    for text, gone in zip(batch.column(text_col).to_pylist(), batch.column(gone_col).to_pylist()):
        if text is not None and gone:
            drop = set(gone)
            text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in drop)
        out.append(text)
    return out


def clean(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text",
          drop_emptied: bool = False) -> DataFrame:
    """``docs`` with the later copies deleted from their texts; with ``drop_emptied`` documents of which
    nothing but white space is left go too (documents that were blank before stay)."""
    joined, gone = _joined(docs, min_words, id_col, text_col)
    columns, at = docs.columns, docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, text_col):
            texts = _cut(b, text_col, gone)
            cols = [pa.array(texts, b.schema.field(i).type) if i == at else b.column(i)
                    for i in range(len(columns))]
            out = pa.RecordBatch.from_arrays(cols, names=columns)
            if drop_emptied:
                cut = [bool(g) for g in b.column(gone).to_pylist()]
                out = out.filter(pa.array([not (c and not (t or "").strip()) for c, t in zip(cut, texts)], pa.bool_()))
            yield out

    return joined.select(*columns, gone).mapInArrow(run, docs.schema)


def report(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``doc_id, n_lines, n_deleted, deleted_lines, text`` per input row (lines of null text: 0)."""
    joined, gone = _joined(docs, min_words, id_col, text_col)
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            lost = [g or [] for g in b.column("gone").to_pylist()]
            n = [0 if t is None else t.count("\n") + 1 for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array([len(g) for g in lost], pa.int64()),
                 pa.array([",".join(map(str, g)) for g in lost], pa.string()),
                 pa.array(_cut(b, "text", "gone"), pa.string())],
                names=["doc_id", "n_lines", "n_deleted", "deleted_lines", "text"])

    return (joined.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(gone).alias("gone"))
            .mapInArrow(run, f"doc_id {kind}, n_lines bigint, n_deleted bigint, deleted_lines string, text string"))


ORACLE_SQL = """
WITH a AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
x AS (
  SELECT doc_id, unnest(range(len(ls))) AS i, unnest(ls) AS line FROM a WHERE text IS NOT NULL),
p AS (
  SELECT doc_id, i, line, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS wc,
         row_number() OVER (PARTITION BY doc_id ORDER BY i) AS j
  FROM x WHERE NOT regexp_full_match(line, '[\\x20\\x09-\\x0D]*')),
pairs AS (
  SELECT l.doc_id, l.i, l.j, l.wc, e.doc_id AS other, l.j - e.j AS lag,
         l.j - row_number() OVER (PARTITION BY l.doc_id, e.doc_id, l.j - e.j ORDER BY l.j) AS island
  FROM p l JOIN p e ON l.line = e.line AND (e.doc_id < l.doc_id OR e.doc_id = l.doc_id AND e.j < l.j)),
gone AS (
  SELECT DISTINCT doc_id, i FROM (
    SELECT doc_id, i, SUM(wc) OVER (PARTITION BY doc_id, other, lag, island) AS words FROM pairs) WHERE words >= 50),
g AS (SELECT doc_id, list(i ORDER BY i) AS gone FROM gone GROUP BY doc_id)
SELECT a.doc_id, CAST(coalesce(len(ls), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_deleted,
       coalesce(array_to_string(gone, ','), '') AS deleted_lines,
       CASE WHEN gone IS NULL THEN text ELSE array_to_string(list_filter(ls, lambda l, k: NOT list_contains(gone, k - 1)), chr(10)) END AS text
FROM a LEFT JOIN g ON g.doc_id = a.doc_id
"""
