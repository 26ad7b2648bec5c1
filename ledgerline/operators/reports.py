"""Reporting queries over payments and audit rows, and the reductions the
dashboard did in the browser, done as Spark aggregates instead."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.functions import in_window, order_free_avg, order_free_sum


def _window(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.filter(in_window("partition_date", start, end))


def audit_summary(audit: DataFrame, start: str, end: str) -> DataFrame:
    """One row: rows, qualified rows (account-days, not distinct accounts),
    average relevant balance, error rate in percent. An empty window gives
    one row with 0 rows and NULL measures."""
    a = _window(audit, start, end)
    total = F.count(F.lit(1))
    return a.agg(
        total.alias("total_registros"),
        F.sum(F.when(F.col("qualified"), 1).otherwise(0)).cast("bigint").alias("cuentas_calificadas"),
        order_free_avg("relevant_balance").alias("saldo_promedio"),
        F.try_divide(
            F.sum(F.when(F.col("process_status") == K.STATUS_ERROR, 1).otherwise(0)).cast("double")
            * F.lit(100.0),
            total.cast("double")).alias("tasa_error"),
    )


def audit_reasons(audit: DataFrame, start: str, end: str) -> DataFrame:
    """Rejection reasons with counts, most frequent first (NULL decisions
    are neither qualified nor rejected and are left out)."""
    a = _window(audit, start, end).filter(~F.col("qualified"))
    return (a.groupBy("reason").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), "reason"))


def payments_by_day(pay: DataFrame, start: str, end: str, ordered: bool = True) -> DataFrame:
    """Per day: accounts paid, total interest, average eligible balance, by
    sums that do not depend on the order of the rows. ``ordered=False`` leaves out
    the sort by day, for use below a further aggregate."""
    p = _window(pay, start, end).groupBy("partition_date").agg(
        F.count("account_id").alias("cuentas"),
        order_free_sum("interest_amount").alias("interes_total"),
        order_free_avg("eligible_balance").alias("saldo_promedio"))
    return p.orderBy("partition_date") if ordered else p


def payments_detail(pay: DataFrame, start: str, end: str,
                    min_balance: float = K.DETAIL_MIN_BALANCE,
                    min_interest: float = K.DETAIL_MIN_INTEREST,
                    k: int = K.DETAIL_LIMIT) -> DataFrame:
    """Top-k payments by interest (the limit is the feature). Ties are broken
    by account, user and day so the cut is deterministic. Spark plans this
    as a per-partition top-k then one merge of k rows per partition."""
    p = _window(pay, start, end).filter(
        (F.col("eligible_balance") >= F.lit(min_balance))
        & (F.col("interest_amount") >= F.lit(min_interest)))
    return (p.select("user_id", "account_id", "eligible_balance", "interest_rate",
                     "interest_amount", "partition_date")
            .orderBy(F.desc("interest_amount"), "account_id", "user_id", "partition_date")
            .limit(k))


def payments_distribution(pay: DataFrame, start: str, end: str) -> DataFrame:
    return _window(pay, start, end).select("interest_amount")


def interest_histogram(pay: DataFrame, start: str, end: str,
                       bins: int = K.HISTOGRAM_BINS) -> DataFrame:
    """Equal-width histogram of interest amounts: ``bin`` 1..n, its edges and
    the count, empty bins included. The top edge belongs to the last bin;
    a constant column puts everything in bin 1.

    One plan: the values meet their own range, a one-row aggregate, by a
    broadcast of that row; no job runs when the report is built. No values
    give no rows.
    """
    v = _window(pay, start, end).select(F.col("interest_amount").cast("double").alias("v")).filter(F.col("v").isNotNull())
    span = v.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).filter(F.col("lo").isNotNull())
    one_row = F.broadcast(span)
    width, n = F.col("hi") - F.col("lo"), F.lit(float(bins))
    raw_bin = F.floor((F.col("v") - F.col("lo")) * n / F.nullif(width, F.lit(0.0))) + F.lit(1)
    bin_of = F.when(width == 0, F.lit(1)).otherwise(F.least(raw_bin, F.lit(bins))).cast("int")
    counts = v.crossJoin(one_row).groupBy(bin_of.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    step = width / n
    axis = (span.select("lo", "hi", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
            .select("bin", (F.col("lo") + (F.col("bin") - 1) * step).alias("bin_lo"),
                    (F.col("lo") + F.col("bin") * step).alias("bin_hi")))
    return (axis.join(counts, "bin", "left")
            .select("bin", "bin_lo", "bin_hi",
                    F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"))
            .orderBy("bin"))


def eligibility_split(audit: DataFrame, start: str, end: str) -> DataFrame:
    """Qualified against not qualified (total minus qualified, so NULL
    decisions count as not qualified), two rows even when one side is 0."""
    a = _window(audit, start, end)
    totals = a.agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(F.when(F.col("qualified"), 1).otherwise(0)).cast("bigint").alias("yes"))
    rows = totals.select(F.stack(
        F.lit(2),
        F.lit(K.SPLIT_QUALIFIED), F.coalesce(F.col("yes"), F.lit(0).cast("bigint")), F.col("total"),
        F.lit(K.SPLIT_NOT_QUALIFIED), F.col("total") - F.coalesce(F.col("yes"), F.lit(0).cast("bigint")),
        F.col("total"),
    ).alias("estado", "cantidad", "total"))
    return rows.select(
        "estado", F.col("cantidad").cast("bigint").alias("cantidad"),
        F.try_divide(F.col("cantidad").cast("double"), F.col("total").cast("double")).alias("share"))


def balance_interest_trend(by_day: DataFrame) -> DataFrame:
    """Correlation and least-squares line of total interest against average
    balance over the days of ``payments_by_day`` (one row); days without
    either are left out of them. Sums about the means, free of row order;
    NULL where they are not defined."""
    x, y = F.col("saldo_promedio"), F.col("interes_total")
    both = x.isNotNull() & y.isNotNull()
    days = Window.partitionBy()     # a row per day
    by_day = by_day.select(x, y).withColumns({"mx": order_free_avg(F.when(both, x), days),
                                              "my": order_free_avg(F.when(both, y), days)})
    dx, dy = F.when(both, x) - F.col("mx"), F.when(both, y) - F.col("my")
    sums = by_day.agg(
        F.count(F.lit(1)).alias("n_days"), F.max("mx").alias("mx"), F.max("my").alias("my"),
        order_free_sum(dx * dx).alias("sxx"), order_free_sum(dy * dy).alias("syy"),
        order_free_sum(dx * dy).alias("sxy"))
    slope = F.try_divide("sxy", "sxx")
    return sums.select(
        "n_days", F.try_divide(F.col("sxy"), F.sqrt(F.col("sxx") * F.col("syy"))).alias("correlation"),
        slope.alias("slope"), (F.col("my") - slope * F.col("mx")).alias("intercept"))


def _total(values):
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def balance_interest_lowess(by_day: DataFrame, fraction: float = 2 / 3, rounds: int = 3) -> DataFrame:
    """The scatter plot's trend line: locally weighted regression (LOWESS) of
    total interest on average balance over the days of ``payments_by_day``:
    day, balance, interest and the fitted interest (``tendencia``).

    Each day is fitted by a line through its nearest ``fraction`` of the days
    in balance, with tricube weights by distance; ``rounds`` times, days far
    from their fit lose weight (bisquare of the residual by six times the
    median residual) and all are fitted again. Neighbours are a slice of the
    days sorted by balance. Equal balances share neighbours; where all
    neighbours have one balance the fit is their mean, where none has any
    weight it is the day's own interest. Days without balance or interest are
    left out.

    The days travel as one sorted array (at most ``files.MAX_SPAN_DAYS`` days).
    """
    point = F.struct(F.col("saldo_promedio").cast("double").alias("x"), F.col("interes_total").cast("double").alias("y"),
                     F.col("partition_date").alias("day"))
    days = by_day.where("saldo_promedio IS NOT NULL AND interes_total IS NOT NULL")
    one = days.agg(F.array_sort(F.collect_list(point)).alias("p")).withColumn(
        "w", F.transform("p", lambda _: F.lit(1.0)))
    for round_ in range(rounds + 1):
        fitted = _local_lines(one, fraction)
        if round_ < rounds:
            one = fitted.agg(F.array_sort(F.collect_list(F.struct("i", "q", "fit"))).alias("r")).select(
                F.transform("r", lambda r: r["q"]).alias("p"),
                F.transform("r", lambda r: F.abs(r["q"]["y"] - r["fit"])).alias("res"))
            ordered = one.withColumns({"s": F.array_sort("res"), "n": F.size("res")})
            middle = (F.get("s", F.floor((F.col("n") - 1) / 2).cast("int")) + F.get("s", F.floor(F.col("n") / 2).cast("int"))) / 2
            one = ordered.withColumn("six", 6 * middle).withColumn("w", F.transform("res", lambda r: F.pow(
                1 - F.pow(F.least(F.when(F.col("six") > 0, r / F.col("six")).otherwise(F.signum(r)), F.lit(1.0)), 2), 2)))
    return fitted.select(F.col("q.day").alias("partition_date"), F.col("q.x").alias("saldo_promedio"),
                         F.col("q.y").alias("interes_total"), F.col("fit").alias("tendencia"))


def _local_lines(one: DataFrame, fraction: float) -> DataFrame:
    """(i, q, fit) for every point q of the sorted array ``p`` with weights ``w``."""
    rows = one.select("p", "w", F.size("p").alias("n"), F.posexplode("p").alias("i", "q"))
    x = F.col("q.x")
    k, left = F.col("k"), F.col("first")
    rows = rows.withColumn("k", F.greatest(F.floor(F.col("n") * fraction + 1e-10).cast("int"),
                                           F.least(F.col("n"), F.lit(2))))
    # the slice moves right while its next point is nearer than its first one
    passed = F.filter(F.sequence(F.lit(0), F.col("n") - k - 1), lambda i: x > (
        F.get(F.col("p"), i)["x"] + F.get(F.col("p"), i + k)["x"]) / 2)
    rows = rows.withColumn("first", F.when(F.col("n") > k, F.size(passed)).otherwise(0))
    rows = rows.withColumns({"near": F.slice("p", left + 1, k), "nw": F.slice("w", left + 1, k)})
    rows = rows.withColumn("h", F.greatest(x - F.element_at("near", 1)["x"], F.element_at("near", -1)["x"] - x))
    rows = rows.withColumn("t", F.zip_with("near", "nw", lambda p, w: w * F.when(F.col("h") > 0, F.pow(
        1 - F.pow(F.least(F.abs(p["x"] - x) / F.col("h"), F.lit(1.0)), 3), 3)).otherwise(1.0)))
    mean = lambda f: _total(F.zip_with("near", "t", lambda p, t: t * f(p))) / F.col("sw")
    rows = rows.withColumn("sw", _total(F.col("t")))
    rows = rows.withColumns({"mx": F.when(F.col("sw") > 0, mean(lambda p: p["x"])),
                             "my": F.when(F.col("sw") > 0, mean(lambda p: p["y"]))})
    rows = rows.withColumns({
        "sxx": F.when(F.col("sw") > 0, mean(lambda p: (p["x"] - F.col("mx")) * (p["x"] - F.col("mx")))),
        "sxy": F.when(F.col("sw") > 0, mean(lambda p: (p["x"] - F.col("mx")) * (p["y"] - F.col("my"))))})
    line = F.col("my") + F.when(F.col("sxx") > 1e-12, (x - F.col("mx")) * F.col("sxy") / F.col("sxx")).otherwise(0.0)
    return rows.select("i", "q", F.when(F.col("sw") > 0, line).otherwise(F.col("q.y")).alias("fit"))
