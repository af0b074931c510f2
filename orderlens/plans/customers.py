"""Customer-grain analyses: CLV, cohort retention, RFM, churn risk, cross-sell.

Every function is ``f(tx, as_of, ...) -> DataFrame`` over the ``transactions``
schema; ``as_of`` replaces the wall clock.  Money stays DECIMAL until the final
projection; rounded outputs are exact (see ``functions.rounding``).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.rounding import as_dec, mean_as_double, percent, round_half_up
from ..operators.band_join import item_pairs
from ..operators.cutpoints import Measure, ntiles

DAYS_PER_YEAR = Decimal("365.25")


def _money(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


# The labels and thresholds the analyses must output, in rule order.
CLV_BANDS = [(2000, "High Value"), (1000, "Medium Value"), (500, "Low Value")]
CLV_DEFAULT_BAND = "Very Low Value"
RFM_CATEGORIES = ["Champions", "Loyal Customers", "Potential Loyalists", "At Risk",
                  "Cannot Lose Them", "New Customers", "Others"]
CHURN_LEVELS = ["High Risk", "Medium Risk", "Low Risk", "Active"]     # > 3x, 2x, 1x the mean gap
CHURN_ACTIONS = ["Priority Retention", "Standard Retention", "Engagement Campaign", "Monitor"]
PRIORITY_SPEND = 1000
ENGAGEMENT_ORDERS = 10


# ---------------------------------------------------------------- Q1 CLV


def customer_metrics(tx: DataFrame) -> DataFrame:
    return tx.groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.sum("order_value").alias("total_spent_dec"),
        mean_as_double("order_value").alias("avg_order_value"),
        (F.datediff(F.max("order_date"), F.min("order_date")) + 1).alias("lifetime"))


def clv(tx: DataFrame, as_of, months: int = 12, ordered: bool = True) -> DataFrame:
    """Annualised customer lifetime value over a trailing window, with value bands."""
    m = customer_metrics(D.trailing(tx, as_of, months=months))
    lifetime = F.col("lifetime")
    yearly_orders = F.when(lifetime > 0, as_dec("total_orders") * F.lit(DAYS_PER_YEAR) / lifetime) \
        .otherwise(as_dec("total_orders"))
    yearly_value = F.when(lifetime > 0, F.col("total_spent_dec") * F.lit(DAYS_PER_YEAR) / lifetime) \
        .otherwise(F.col("total_spent_dec"))
    band = F.when(F.col("_clv") >= CLV_BANDS[0][0], CLV_BANDS[0][1])
    for threshold, label in CLV_BANDS[1:]:
        band = band.when(F.col("_clv") >= threshold, label)
    out = (m.withColumn("_clv", yearly_value).withColumn("_freq", yearly_orders)
           .select("customer_id",
                   _money("total_spent_dec").alias("total_spent"),
                   "total_orders", "avg_order_value",
                   lifetime.cast("bigint").alias("customer_lifetime_days"),
                   round_half_up(F.col("_freq")).alias("projected_annual_orders"),
                   round_half_up(F.col("_clv")).alias("customer_lifetime_value"),
                   band.otherwise(CLV_DEFAULT_BAND).alias("customer_segment"),
                   "_clv"))
    if ordered:
        out = out.orderBy(F.col("_clv").desc_nulls_last(), "customer_id")
    return out.drop("_clv")


def clv_simple(tx: DataFrame) -> DataFrame:
    """The short CLV variant: all history, COUNT(*), no +1 day, 365-day year.

    A one-day customer has lifetime 0; the value is NULL instead of a division error.
    """
    m = tx.groupBy("customer_id").agg(
        F.sum("order_value").alias("s"), F.count(F.lit(1)).alias("total_orders"),
        F.datediff(F.max("order_date"), F.min("order_date")).alias("lifetime"))
    yearly = F.try_divide(F.col("s") * F.lit(365), F.col("lifetime"))
    return m.select("customer_id", _money("s").alias("total_spent"), "total_orders",
                    round_half_up(yearly, 6).alias("annualized_clv"))


# ---------------------------------------------------------------- Q2 cohorts
def _period_index(ts: Column, period: str) -> Column:
    """Number of the calendar month or of the Monday week, without gaps."""
    if period == "monthly":
        return F.year(ts) * 12 + F.month(ts) - 1
    if period == "weekly":
        return F.floor((F.unix_date(F.date_trunc("week", ts).cast("date")) - _FIRST_MONDAY) / 7).cast("int")
    raise ValueError(f"period must be 'monthly' or 'weekly', not {period!r}")


def _period_label(idx: Column, period: str) -> Column:
    if period == "monthly":
        return F.format_string("%04d-%02d", F.floor(idx / 12).cast("int"), F.pmod(idx, F.lit(12)).cast("int") + 1)
    return F.date_format(F.date_from_unix_date((idx * 7 + _FIRST_MONDAY).cast("int")), "yyyy-MM-dd")


_FIRST_MONDAY = 4                    # 1970-01-05, in days after the epoch
_WORD = 32                           # periods of a word; a customer's row sees two words, so 32 periods after the first
_MOST_HORIZON = 32
_WORD_SHIFT = 1 << 19                # word numbers are stored from 0 on


def cohort_retention(tx: DataFrame, period: str = "monthly", horizon: int = 12,
                     ordered: bool = True) -> DataFrame:
    """Customers retained per first-period cohort and periods since the first order.

    A customer's active periods are bitmaps: every order sets its bit in its own 32-period word and, one word
    on, in the word before, so a word's row sees the 32 periods that follow any period of it.  ``bit_or``
    combines map-side; the earliest word of a customer gives the first period (lowest bit) and the bits of
    the horizon after it, packed into one LONG whose minimum is taken.  Buffers are fixed numbers however
    active a customer is.  Cohort size = customers active in period 0.
    """
    if not 0 <= horizon <= _MOST_HORIZON:
        raise ValueError(f"horizon must lie between 0 and {_MOST_HORIZON}")
    idx = _period_index(F.col("order_date"), period)
    one = F.lit(1).cast("bigint")
    rows = (tx.filter(F.col("customer_id").isNotNull() & F.col("order_date").isNotNull())
            .select("customer_id", idx.alias("i"))
            .select("customer_id", F.shiftright("i", 5).alias("w"), F.call_function("shiftleft", one, F.col("i").bitwiseAND(_WORD - 1)).alias("b"))
            .select("customer_id", F.explode(F.array(
                F.struct("w", "b"), F.struct((F.col("w") - 1).alias("w"), F.shiftleft("b", _WORD).alias("b")))).alias("e"))
            .select("customer_id", "e.w", "e.b"))
    words = rows.groupBy("customer_id", "w").agg(F.bit_or("b").alias("b"))
    low = F.col("b").bitwiseAND(F.lit((1 << _WORD) - 1))
    # the lowest set bit: as many ones lie below it as its number
    lowest = F.bit_count((low.bitwiseAND(-low)) - 1)
    after = F.call_function("shiftrightunsigned", F.col("b"), F.col("t").cast("int")).bitwiseAND(F.lit((1 << (horizon + 1)) - 1))
    packed = (((F.col("w") + _WORD_SHIFT).cast("bigint") * _WORD + F.col("t")) * (1 << (horizon + 1))) + F.col("a")
    firsts = (words.filter(low != 0).withColumn("t", lowest.cast("bigint")).withColumn("a", after)
              .groupBy("customer_id").agg(F.min(packed).alias("p")))
    start = F.shiftright("p", horizon + 1)
    active = (firsts.select((start - F.lit(_WORD_SHIFT * _WORD)).alias("cohort"), F.col("p").bitwiseAND(F.lit((1 << (horizon + 1)) - 1)).alias("a"))
              .groupBy("cohort", "a").agg(F.count(F.lit(1)).alias("c")))
    counts = (active.select("cohort", "c", "a", F.explode(F.sequence(F.lit(0), F.lit(horizon))).alias("n"))
              .filter(F.call_function("getbit", F.col("a"), F.col("n")) == 1)
              .groupBy("cohort", "n").agg(F.sum("c").alias("customers_retained")))
    size = F.max(F.when(F.col("n") == 0, F.col("customers_retained"))).over(
        Window.partitionBy("cohort"))
    names = ("cohort_month", "month_number") if period == "monthly" else ("cohort_week", "week_number")
    out = (counts.withColumn("cohort_size", size)
           .select(_period_label(F.col("cohort"), period).alias(names[0]),
                   F.col("n").cast("bigint").alias(names[1]),
                   "customers_retained", "cohort_size",
                   percent(F.col("customers_retained"), F.col("cohort_size")).alias("retention_rate")))
    return out.orderBy(*names) if ordered else out


# ---------------------------------------------------------------- Q3 RFM
def rfm(tx: DataFrame, as_of, months: int = 12, orientation: str = "as_written",
        ordered: bool = True, ntile=None) -> DataFrame:
    """RFM scores (three global NTILE(5)) and the seven ordered categories.

    ``orientation='as_written'`` sorts recency ASC, frequency and monetary DESC
    (best customers score 1); ``'conventional'`` reverses the three sorts.
    Ties are broken by ``customer_id``.  The customers that begin the tiles of all three scores are
    looked up when the function is called (``operators.cutpoints``); ``ntile`` may be another
    implementation, one score at a time.
    """
    base = (D.trailing(tx, as_of, months=months).groupBy("customer_id")
            .agg(F.datediff(D.lit_date(as_of), F.max("order_date")).cast("bigint").alias("recency_days"),
                 F.count_distinct("order_id").alias("frequency"),
                 F.sum("order_value").alias("monetary")))
    conventional = orientation == "conventional"
    if orientation not in ("as_written", "conventional"):
        raise ValueError("orientation must be 'as_written' or 'conventional'")

    def key(c: str, asc: bool) -> list[Column]:
        first = F.col(c).asc_nulls_first() if asc else F.col(c).desc_nulls_last()
        return [first, F.col("customer_id").asc_nulls_first()]

    if ntile is None:
        scored = ntiles(base, "customer_id", {"recency_score": Measure("recency_days", not conventional),
                                              "frequency_score": Measure("frequency", conventional),
                                              "monetary_score": Measure("monetary", conventional)}, 5)
    else:
        scored = ntile(base, 5, key("recency_days", not conventional), "recency_score")
        scored = ntile(scored, 5, key("frequency", conventional), "frequency_score")
        scored = ntile(scored, 5, key("monetary", conventional), "monetary_score")
    r, f, m = F.col("recency_score"), F.col("frequency_score"), F.col("monetary_score")
    champions, loyal, potential, at_risk, cannot_lose, new, others = RFM_CATEGORIES
    category = (F.when((r >= 4) & (f >= 4) & (m >= 4), champions)
                .when((r >= 3) & (f >= 3) & (m >= 3), loyal)
                .when((r >= 3) & (f <= 2), potential)
                .when((r <= 2) & (f >= 3), at_risk)
                .when((r <= 2) & (f <= 2) & (m >= 3), cannot_lose)
                .when((r >= 3) & (f <= 1), new)
                .otherwise(others))
    out = scored.select("customer_id", "recency_days", "frequency",
                        round_half_up(F.col("monetary")).alias("monetary_value"),
                        "recency_score", "frequency_score", "monetary_score",
                        F.concat(r, f, m).alias("rfm_segment"),
                        category.alias("customer_category"))
    if ordered:
        out = out.orderBy(m.desc(), f.desc(), r.desc(), "customer_id")
    return out


# ---------------------------------------------------------------- Q7 churn risk
def churn_risk(tx: DataFrame, as_of, min_orders: int = 2, ordered: bool = True) -> DataFrame:
    """Recency against the customer's own mean gap between consecutive orders.

    The mean of ``DATEDIFF(order_date, LAG(order_date))`` over a customer's
    dated orders telescopes to ``DATEDIFF(max, min) / (dated orders - 1)``, so
    the whole analysis is aggregation by customer (the distinct orders first): no
    per-customer sort, no hot-customer task.  (``operators.gaps`` has the literal window form.)
    """
    g = tx.groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.max("order_date").alias("last_order_date"),
        F.datediff(D.lit_date(as_of), F.max("order_date")).cast("bigint").alias("days_since_last_order"),
        F.datediff(F.max("order_date"), F.min("order_date")).alias("gap_days"),
        (F.count("order_date") - 1).alias("gaps"),
        F.sum("order_value").alias("spent"),
        F.count("order_value").alias("valued"))
    g = g.filter((F.col("total_orders") >= min_orders) & (F.col("gaps") >= 1))
    mean_gap = F.col("gap_days") / F.col("gaps")          # double, unrounded
    days = F.col("days_since_last_order")
    high, medium, low, active = CHURN_LEVELS
    level = (F.when(days > mean_gap * 3, high).when(days > mean_gap * 2, medium)
             .when(days > mean_gap, low).otherwise(active))
    spent = F.round(F.col("spent"), 2)
    lvl = F.col("churn_risk_level")
    priority, standard, engagement, monitor = CHURN_ACTIONS
    action = (F.when((lvl == high) & (F.col("total_spent") >= PRIORITY_SPEND), priority)
              .when(lvl == high, standard)
              .when((lvl == medium) & (F.col("total_orders") >= ENGAGEMENT_ORDERS), engagement)
              .otherwise(monitor))
    out = (g.select("customer_id", "total_orders", "last_order_date", "days_since_last_order",
                    round_half_up(as_dec("gap_days") / F.col("gaps")).alias("avg_days_between_orders"),
                    spent.cast("double").alias("total_spent"),
                    round_half_up(F.try_divide(F.col("spent"), F.col("valued"))).alias("avg_order_value"),
                    level.alias("churn_risk_level"))
           .withColumn("recommended_action", action))
    if ordered:
        rank = F.when(lvl == high, 1).when(lvl == medium, 2).when(lvl == low, 3).otherwise(4)
        out = out.orderBy(rank, F.col("total_spent").desc(), "customer_id")
    return out


# ---------------------------------------------------------------- Q8 cross-sell
def _rank_preferences(prefs: DataFrame) -> DataFrame:
    rank = F.rank().over(Window.partitionBy("customer_id").orderBy(F.col("orders_count").desc()))
    return prefs.withColumn("preference_rank", rank.cast("bigint"))


def cuisine_preferences(tx: DataFrame, as_of, months: int = 6) -> DataFrame:
    """Per customer and cuisine: orders, spend and rank by orders (ties share a rank).

    The window runs over per-customer cuisine rows (bounded by the cuisine domain).
    """
    prefs = (D.trailing(tx, as_of, months=months).groupBy("customer_id", "cuisine_type")
             .agg(F.count(F.lit(1)).alias("orders_count"),
                  F.sum("order_value").alias("spent_on_cuisine")))
    return _rank_preferences(prefs)


def _pairs_table(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("item_1").alias("cuisine_1"), F.col("item_2").alias("cuisine_2"),
                        F.col("keys").alias("customers_ordering_both"),
                        F.col("pairs").alias("order_pairs"),
                        round_half_up(F.try_divide(F.col("value_sum"), F.col("valued_pairs")))
                        .alias("avg_combined_order_value"))


def cuisine_pairs(tx: DataFrame, band_days: int = 30, min_customers: int = 10,
                  pair_since=None) -> DataFrame:
    """Ordered cuisine pairs bought by one customer within ``band_days`` of each other."""
    src = tx if pair_since is None else D.since(tx, D.lit_date(pair_since))
    return _pairs_table(item_pairs(src, band_days, min_customers))


def cross_sell(tx: DataFrame, as_of, months: int = 6, band_days: int = 30,
               min_customers: int = 10, pair_since=None, ordered: bool = True) -> DataFrame:
    """Recommend cuisines paired with the customer's primary cuisine but not yet ordered.

    Preferences read only the trailing window (partition-pruned on a table
    partitioned by month); the pairs read all history, pre-aggregated once
    into day cells.  NOT EXISTS becomes a membership test against the
    customer's set of ordered cuisines, built by the same window that ranks
    the preferences.  The pair table has at most cuisines^2 rows; AQE
    broadcasts it once its size is measured.
    """
    prefs = cuisine_preferences(tx, as_of, months)
    # cuisines the customer already ordered, carried on every preference row
    # (a set bounded by the cuisine domain) instead of a second scan + anti join
    seen = F.collect_set("cuisine_type").over(Window.partitionBy("customer_id"))
    primary = (prefs.withColumn("_seen", seen).filter(F.col("preference_rank") == 1)
               .select("customer_id", F.col("cuisine_type").alias("primary_cuisine"),
                       F.col("orders_count").alias("primary_orders"),
                       F.col("spent_on_cuisine").alias("primary_spent"), "_seen"))
    pairs = cuisine_pairs(tx, band_days, min_customers, pair_since)
    recs = (primary.join(pairs, F.col("primary_cuisine") == F.col("cuisine_1"))
            .filter(~F.array_contains(F.col("_seen"), F.col("cuisine_2"))))
    out = recs.select("customer_id", "primary_cuisine", "primary_orders",
                      _money("primary_spent").alias("primary_spent"),
                      F.col("cuisine_2").alias("recommended_cuisine"),
                      F.col("customers_ordering_both").alias("market_validation"),
                      F.col("avg_combined_order_value").alias("potential_order_value"))
    if ordered:
        out = out.orderBy(F.col("primary_spent").desc(), F.col("market_validation").desc(),
                          "customer_id", "recommended_cuisine")
    return out
