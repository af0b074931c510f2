"""Operator 10: weak supervision of quality rules (DataFrame functions only).

Each rule votes good (1), bad (-1) or abstains (0).  Expectation-maximisation over the counts of
vote patterns estimates the share of good documents and each rule's accuracy, with no labels; the
posterior probability of "good" given a document's votes replaces "every rule must pass".  The
patterns number at most ``3 ** rules`` whatever the corpus; each EM step is one aggregation over
them and only the parameters come to the driver.

Measures are taken inside the row that holds the text (array functions), so texts are never
shuffled; the slim measures are written once into the shared folder and read again.

Cases: null and empty texts have no words and fail the base rules; repeated rows get equal results;
an empty table keeps the starting parameters; other columns are not read.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import id_and_text, materialise

WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
KEEP_AT = 0.5
# Beta priors of EM as pseudo-counts (for, against): of a rule's right votes, and of good documents.
RIGHT, GOOD = (30.0, 10.0), (8.0, 2.0)


class Model(NamedTuple):
    prior: float
    accuracy: dict[str, float]


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the counts the rules use, one row per input row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.btrim(text, F.lit(WHITE))
    no_words = F.array().cast("array<string>")
    one = id_and_text(docs, id_col, text_col).select(
        "doc_id",
        F.when(trimmed == "", no_words).otherwise(F.split(trimmed, WHITE_RUN)).alias("w"),
        F.translate(text, WHITE, "").alias("solid"),
        F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "").alias("lines"))
    two = one.select(
        "doc_id", F.size("w").alias("n_words"), F.length("solid").alias("word_chars"),
        (F.length("solid") - F.length(F.translate("solid", SYMBOLS, ""))).alias("n_symbols"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.size(F.filter("lines", lambda x: F.substring(F.btrim(x, F.lit(WHITE)), -1, 1)
                        .isin(".", "!", "?", "\"", ":", ";"))).alias("n_closed_lines"),
        F.size(F.array_distinct("w")).alias("n_distinct"),
        F.when(F.size("w") > WINDOW, _windows(F.col("w"))).alias("win"))
    # most texts repeat no window; only the others sort theirs
    three = two.withColumn("seen", F.when(
        F.size(F.array_distinct("win")) < F.size("win"),
        F.sort_array(F.transform("win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    return three.select(
        "doc_id", *[F.col(c).cast("bigint").alias(c) for c in
                    ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_closed_lines", "n_distinct")],
        F.coalesce(_covered(F.col("seen")), F.lit(0)).cast("bigint").alias("n_repeat_words"))


def _windows(w: Column) -> Column:
    """A 64-bit hash of every window of words."""
    return F.transform(F.sequence(F.lit(1), F.size(w) - WINDOW + 1),
                       lambda i: F.xxhash64(F.slice(w, i, F.lit(WINDOW))))


def _covered(seen: Column) -> Column:
    """Words inside windows that are equal to a neighbour in the sorted list of (hash, place)."""
    n = F.size(seen)
    before = F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), F.slice(seen, F.lit(1), n - 1))
    after = F.slice(seen, F.lit(2), n - 1)         # zip_with pads the shorter side with null
    flagged = F.zip_with(
        F.zip_with(seen, before, lambda a, b: F.struct(a.h.alias("h"), a.i.alias("i"),
                                                       F.coalesce(a.h == b.h, F.lit(False)).alias("r"))),
        after, lambda a, b: F.when(a.r | F.coalesce(a.h == b.h, F.lit(False)), a.i))
    places = F.sort_array(F.array_compact(flagged))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
    return F.aggregate(places, zero, lambda a, i: F.struct(
        (a.n + (i + WINDOW - F.greatest(i, a.upto))).alias("n"), (i + WINDOW).alias("upto"))).n


def _vote(good: Column, bad: Column) -> Column:
    return F.when(F.coalesce(bad, F.lit(False)), -1).when(F.coalesce(good, F.lit(False)), 1).otherwise(0)


def votes() -> dict[str, Column]:
    """The rules over ``measures``: 1 good, -1 bad, 0 abstains."""
    n = F.col("n_words")
    some = n >= MIN_WORDS
    mean = F.col("word_chars") / F.when(n > 0, n)
    share = lambda c, of: F.col(c) / F.when(F.col(of) > 0, F.col(of))
    return {
        "length": _vote(n >= 2 * MIN_WORDS, n < MIN_WORDS),
        "word_length": _vote(some & mean.between(3, 12), (mean < 2) | (mean > 20)),
        "symbols": _vote(some & (share("n_symbols", "n_words") <= 0.05), share("n_symbols", "n_words") > 0.2),
        "dup_lines": _vote((F.col("n_lines") >= 2) & (F.col("n_dup_lines") == 0),
                           share("n_dup_lines", "n_lines") > 0.3),
        "repeats": _vote(some & (F.col("n_repeat_words") == 0), share("n_repeat_words", "n_words") > 0.2),
        "closed_lines": _vote(some & (share("n_closed_lines", "n_lines") >= 0.5),
                              share("n_closed_lines", "n_lines") < 0.1),
        "variety": _vote(some & (share("n_distinct", "n_words") >= 0.25),
                         some & (share("n_distinct", "n_words") < 0.1)),
    }


def _log_odds(model: Model) -> Column:
    total = F.lit(math.log(model.prior / (1 - model.prior)))
    for name, a in model.accuracy.items():
        total = total + F.col(f"vote_{name}") * F.lit(math.log(a / (1 - a)))
    return total


def posterior(model: Model) -> Column:
    return 1 / (1 + F.exp(-_log_odds(model)))


def fit(voted: DataFrame, rules: list[str], steps: int = 30, start: float = 0.75, prior: float = 0.8,
        tolerance: float = 1e-5) -> Model:
    """EM over the pattern counts; runs one small job per step.

    ``RIGHT`` and ``GOOD`` are added to the counts, so no estimate reaches 0 or 1 and a few votes say little; a
    rule that the others contradict on enough documents falls below one half and then counts against
    its own vote.
    """
    cols = [f"vote_{r}" for r in rules]
    patterns = materialise(voted.groupBy(*cols).agg(F.count("*").alias("n")).coalesce(1), "vote_patterns")
    model = Model(prior, {r: start for r in rules})
    for _ in range(steps):
        p, n = F.col("p"), F.col("n")
        aggs = [F.sum(n).alias("all"), F.sum(n * p).alias("good")]
        for r in rules:
            v = F.col(f"vote_{r}")
            aggs += [F.sum(F.when(v == 1, n * p).when(v == -1, n * (1 - p)).otherwise(0.0)).alias(f"right_{r}"),
                     F.sum(F.when(v != 0, n).otherwise(0)).alias(f"cast_{r}")]
        s = patterns.withColumn("p", posterior(model)).agg(*aggs).first()
        if not s["all"]:
            return model
        new = Model((s["good"] + GOOD[0]) / (s["all"] + sum(GOOD)),
                    {r: (s[f"right_{r}"] + RIGHT[0]) / (s[f"cast_{r}"] + sum(RIGHT)) for r in rules})
        change = max(abs(new.prior - model.prior),
                     *(abs(new.accuracy[r] - model.accuracy[r]) for r in rules))
        model = new
        if change < tolerance:
            break
    return model


def judge(docs: DataFrame, keep_at: float = KEEP_AT, **options) -> DataFrame:
    """Measures, ``base_failed``, votes, ``posterior`` and ``kept``; runs jobs when called."""
    rules = votes()
    voted = materialise(measures(docs, **options).select(
        "*", *[v.alias(f"vote_{r}") for r, v in rules.items()]), "quality_measures")
    model = fit(voted, list(rules))
    failed = ((F.col("n_words") < MIN_WORDS)
              | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    return (voted.withColumn("base_failed", failed).withColumn("posterior", posterior(model))
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= keep_at)))
