"""Operator 2: benchmark decontamination by a prefix-filtered set join (DataFrame functions only).

Every benchmark item is cut into windows of ``WINDOW`` words (a shorter item is one window).
A window is a set of word shingles; a document that holds the window holds all of them, so
by the prefix filter for full containment one shingle per window is enough to find it: the rarest
in the documents.  Steps:

1. count, over all documents, the shingles that occur in the benchmark (rarity order);
   windows with a shingle that never occurs are gone;
2. join the documents' shingles with one prefix shingle per remaining window, keep pairs whose
   window fits between the document's ends at that place (positional and length bounds), and
   compare the item-sized stretch of the document word by word;
3. per document, unite the hit stretches and gather the items.

The benchmark side is broadcast while its size, counted first, is at most ``BROADCAST_WINDOWS``
windows; beyond it the same joins are shuffled and the words are joined back by document.

Cases: null text has no words; an empty benchmark or item hits nothing; repeated rows (same id and
text) each get a result row, rows of one id with different texts are separate documents; repeated
item ids count once; an item without id hits words but cannot be listed; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import fresh, id_and_text

WINDOW = 10
SHINGLE = 5
# About 150 bytes each in a broadcast relation: some 75 MB.
BROADCAST_WINDOWS = 500_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    return F.coalesce(F.array_remove(F.split(F.translate(text, UPPER, LOWER), SEPARATORS), ""),
                      F.array().cast("array<string>"))


def item_windows(benchmark: DataFrame, window: int, item_col: str, text_col: str) -> DataFrame:
    """``item_id, win`` (array of words), one row per window place."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item_id"), words(F.col(text_col)).alias("w"))
    places = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    return (items.filter(F.size("w") > 0)
            .select("item_id", "w", F.explode(places).alias("p"))
            .select("item_id", F.slice("w", F.col("p"), F.lit(window)).alias("win")))


def _shingle_of(arr: str, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(F.col(arr), at + k) for k in range(size)])


def _places(docs: DataFrame, size: int, marker: bool) -> DataFrame:
    """One row per shingle place; with ``marker`` also one with ``pos = -1`` per document."""
    first = F.lit(-1 if marker else 0)
    spots = F.when(F.size("w") >= size, F.sequence(first, F.size("w") - size))
    if marker:
        spots = F.coalesce(spots, F.array(F.lit(-1)))
    return (docs.select("doc_id", "th", "w", F.explode(spots).alias("pos"))
            .withColumn("h", F.when(F.col("pos") >= 0, _shingle_of("w", F.col("pos"), size))
                        if marker else _shingle_of("w", F.col("pos"), size)))


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
         broadcast_windows: int = BROADCAST_WINDOWS, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id") -> DataFrame:
    """One row per document: ``doc_id, th, copies, n_words, spans, n_hit, items``.

    ``spans`` are the hit stretches (start, end) in words, ``items`` the sorted ids as strings,
    ``copies`` the number of input rows with this id and text (``th`` hashes the text).
    """
    base = (id_and_text(docs, id_col, text_col)
            .select("doc_id", F.xxhash64("text").alias("th"), words(F.col("text")).alias("w")))
    by_item = item_windows(benchmark, window, item_col, "text").distinct()
    wins = by_item.select("win").distinct().withColumn("wid", F.xxhash64(F.array_join("win", " ")))
    n_windows = wins.count()
    small = F.broadcast if n_windows <= broadcast_windows else (lambda df: df)
    sizes = sorted(r.n for r in wins.select(F.least(F.size("win"), F.lit(shingle)).alias("n"))
                   .distinct().collect())                              # 1 to `shingle`: at most five values

    found = None
    for k, size in enumerate(sizes):
        own = wins.filter(F.least(F.size("win"), F.lit(shingle)) == size)
        grams = (own.select("wid", "win", F.explode(F.sequence(F.lit(0), F.size("win") - size)).alias("j"))
                 .withColumn("h", _shingle_of("win", F.col("j"), size)))
        seen = (_places(base, size, False).select("h")
                .join(small(grams.select("h").distinct()), "h").groupBy("h").agg(F.count("*").alias("freq")))
        # the rarest shingle of each window, first place on ties; a shingle that never occurs ends it
        prefix = (grams.join(seen, "h", "left")
                  .groupBy("wid", "win").agg(
                      F.min(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "h", "j")).alias("rare"))
                  .filter(F.col("rare.freq") > 0)
                  .select("wid", "win", F.col("rare.h").alias("ph"), F.col("rare.j").alias("j"),
                          F.size("win").alias("len")))
        part = _verified(base, _places(base, size, k == 0), prefix, small, n_windows <= broadcast_windows)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = base.select("doc_id", "th", F.size("w").alias("n_words"), F.lit(1).alias("marker"),
                            F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("len"),
                            F.lit(None).cast("bigint").alias("wid"))

    per_doc = (found.groupBy("doc_id", "th")
               .agg(F.max("n_words").alias("n_words"), F.sum("marker").alias("copies"),
                    F.array_sort(F.collect_set(F.when(F.col("start").isNotNull(), F.struct(
                        "start", (F.col("start") + F.col("len")).alias("end"))))).alias("spans"),
                    F.collect_set("wid").alias("wids")))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
    united = F.aggregate("spans", zero, lambda a, s: F.struct(
        (a.n + F.greatest(s.end - F.greatest(s.start, a.upto), F.lit(0))).alias("n"),
        F.greatest(a.upto, s.end).alias("upto")))
    named = by_item.select(F.xxhash64(F.array_join("win", " ")).alias("wid"), "item_id").distinct()
    return (per_doc.withColumn("n_hit", united.n)
            .select("doc_id", "th", "copies", "n_words", "n_hit", "spans", F.explode_outer("wids").alias("wid"))
            .join(small(named), "wid", "left")
            .groupBy("doc_id", "th", "copies", "n_words", "n_hit", "spans")
            .agg(F.array_sort(F.collect_set("item_id")).alias("items")))


def _verified(base: DataFrame, places: DataFrame, prefix: DataFrame, small, in_memory: bool) -> DataFrame:
    """Marker rows and verified hits: ``doc_id, th, n_words, marker, start, len, wid``."""
    start = F.col("pos") - F.col("j")
    fits = (start >= 0) & (start + F.col("len") <= F.size("w"))
    equal = F.slice("w", start + 1, F.col("len")) == F.col("win")
    if in_memory:
        rows = places.join(small(prefix), (F.col("h") == F.col("ph")) & fits & equal, "left")
    else:
        # the words stay behind while places are shuffled, and are joined back for the comparison
        candidates = (places.filter("pos >= 0").select("doc_id", "th", "h", "pos", F.size("w").alias("n"))
                      .join(prefix, F.col("h") == F.col("ph"))
                      .filter((start >= 0) & (start + F.col("len") <= F.col("n"))).drop("h", "n").distinct())
        texts = base.dropDuplicates(["doc_id", "th"]).withColumnsRenamed({"doc_id": "d", "th": "t"})
        met = (candidates.join(texts, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")))
               .filter(equal).select("doc_id", "th", "w", "pos", "j", "len", "wid"))
        rows = places.filter("pos = -1").select("doc_id", "th", "w", "pos").unionByName(
            met, allowMissingColumns=True)
    return (rows.filter((F.col("pos") == -1) | F.col("wid").isNotNull())
            .select("doc_id", "th", F.size("w").alias("n_words"),
                    F.when(F.col("pos") == -1, 1).otherwise(0).alias("marker"),
                    F.when(F.col("pos") >= 0, start).alias("start"),
                    F.when(F.col("pos") >= 0, F.col("len")).alias("len"),
                    F.when(F.col("pos") >= 0, F.col("wid")).alias("wid")))


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    return (hits(docs, benchmark, **options)
            .select("doc_id", F.col("n_words").cast("bigint").alias("n_words"),
                    F.col("n_hit").cast("bigint").alias("n_hit"),
                    F.size("items").cast("bigint").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated"),
                    F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
            .drop("copy"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          **options) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark window."""
    th, d, t = (fresh(docs, x) for x in ("text_hash", "hit_doc", "hit_hash"))
    bad = (hits(docs, benchmark, id_col=id_col, text_col=text_col, **options).filter("n_hit > 0")
           .select(F.col("doc_id").alias(d), F.col("th").alias(t)))
    return (docs.withColumn(th, F.xxhash64(F.col(text_col)))
            .join(bad, F.col(id_col).eqNullSafe(F.col(d)) & (F.col(th) == F.col(t)), "left_anti").drop(th))


#: DuckDB: the same result from string windows.
ORACLE_SQL = r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
    FROM documents),
iw AS (SELECT CAST(item_id AS VARCHAR) AS item_id, list_filter(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
    FROM benchmark),
ip AS (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS p FROM iw WHERE len(w) > 0),
wins AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p:p + 9], ' ') AS win FROM ip),
lens AS (SELECT DISTINCT n FROM wins),
dp AS (SELECT doc_id, n, unnest(generate_series(1, len(w) - n + 1)) AS p, w FROM w, lens WHERE len(w) >= n),
dg AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS win FROM dp),
hit AS (SELECT DISTINCT dg.doc_id, dg.p, dg.n, wins.item_id FROM dg JOIN wins ON dg.n = wins.n AND dg.win = wins.win),
pos AS (SELECT DISTINCT doc_id, unnest(generate_series(p, p + n - 1)) AS q FROM hit),
nh AS (SELECT doc_id, count(*) AS n_hit FROM pos GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
       FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN nh ON nh.doc_id = w.doc_id LEFT JOIN it ON it.doc_id = w.doc_id
"""
