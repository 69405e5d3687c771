"""Drift report over the most recent predictions."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.rounding import percent_text, round_exact
from .skew import small_table

# fixed values: bin edges i/10 as the double product i * 0.1, last bin closed on the right
_EDGES = [i * 0.1 for i in range(K.PSI_BINS)] + [1.0]


def recent(predictions: DataFrame, limit: int = K.RECENT_LIMIT) -> DataFrame:
    """Newest predictions; equal times are ordered by id."""
    return predictions.orderBy(F.col("created_at").desc(), F.col("id").desc()).limit(limit)


def windows(rows: DataFrame, limit: int = K.RECENT_LIMIT) -> DataFrame:
    """Newest half 'current', older half 'reference' (which gets the odd row).

    Only for the at most ``limit`` rows that ``recent`` returns.
    """
    newest = recent(rows, limit)
    place = F.row_number().over(
        Window.partitionBy(F.lit(0)).orderBy(F.col("created_at").desc(), F.col("id").desc()))
    n = F.count(F.lit(1)).over(Window.partitionBy(F.lit(0)))
    return newest.withColumns({"_place": place, "_n": n}).withColumn(
        "window", F.when(F.col("_place") <= F.floor(F.col("_n") / 2), "current")
        .otherwise("reference")
    ).drop("_place", "_n")


def window_metrics(rows: DataFrame) -> DataFrame:
    """One row of rates and confidence moments per window."""
    n = F.count(F.lit(1))

    def rate(cond: Column) -> Column:
        return F.count_if(cond) / n

    raw = rows.groupBy("window").agg(
        n.alias("n"),
        rate(F.col("layer1_label") == "harmful").alias("harmful_rate"),
        rate(F.col("decision") == K.REVIEW).alias("review_rate"),
        rate(F.col("decision") == K.ALLOW).alias("allow_rate"),
        rate(F.col("priority") == "urgent").alias("urgent_rate"),
        rate(F.coalesce("is_cross_medium", F.lit(False))).alias("cross_medium_rate"),
        F.avg("match_confidence").alias("mean_match_confidence"),
        F.stddev_pop("match_confidence").alias("std_match_confidence"),
        rate(F.col("feature_score").isNull()).alias("feature_missing_rate"),
        rate(F.col("reviewer_verdict").isNotNull()).alias("override_rate"),
    )
    return raw.select(*[
        F.col(c) if c in ("window", "n") else round_exact(F.col(c), 4).alias(c)
        for c in raw.columns
    ])


def score_bin(c: Column) -> Column:
    """Bin number 0-9 by the exact edges; NULL outside [0, 1]."""
    out = F.when((c < 0) | (c > 1), F.lit(None).cast("int"))
    for i in range(K.PSI_BINS - 1):
        out = out.when(c < _EDGES[i + 1], i)
    return out.when(c <= 1, K.PSI_BINS - 1)


def psi(rows: DataFrame, value: str = "match_confidence") -> DataFrame:
    """Population stability index of current against reference, one row.

    Values outside [0, 1] count only in the totals. NULL when a window has no value.
    """
    counts = rows.select("window", F.col(value).isNotNull().alias("known"),
                         score_bin(F.col(value)).alias("bin")).groupBy("window", "known", "bin") \
        .agg(F.count(F.lit(1)).alias("n"))
    sums = []
    for side, window in (("c", "current"), ("r", "reference")):
        mine = (F.col("window") == window) & F.col("known")
        sums.append(F.sum(F.when(mine, F.col("n"))).alias(f"{side}_n"))
        sums += [
            F.coalesce(F.sum(F.when(mine & (F.col("bin") == i), F.col("n"))), F.lit(0))
            .alias(f"{side}{i}") for i in range(K.PSI_BINS)
        ]
    shares = counts.agg(*sums).select("c_n", "r_n", *[
        ((F.col(f"{side}{i}") + K.PSI_SMOOTHING)
         / (F.col(f"{side}_n") + K.PSI_SMOOTHING * K.PSI_BINS)).alias(f"{side}{i}")
        for side in "cr" for i in range(K.PSI_BINS)
    ])
    total = F.lit(0.0)
    for i in range(K.PSI_BINS):
        c, r = F.col(f"c{i}"), F.col(f"r{i}")
        total = total + (c - r) * F.log(c / r)
    # an empty side has a NULL count, which makes the sum NULL
    return shares.select(total.alias("raw")).select(round_exact(F.col("raw"), 4).alias("psi"))


def _side_by_side(metrics: DataFrame) -> DataFrame:
    """Both windows as one row: c_<metric>, r_<metric>."""
    names = ("n", "harmful_rate", "override_rate", "feature_missing_rate")
    return metrics.agg(*[
        F.max(F.when(F.col("window") == window, F.col(m))).alias(f"{side}_{m}")
        for side, window in (("c", "current"), ("r", "reference")) for m in names
    ])


def alerts(metrics: DataFrame, psi_row: DataFrame) -> DataFrame:
    """(type, severity, value, message) of every rule that fires; all comparisons are strict."""
    c = F.col
    one = _side_by_side(metrics).withColumn("k", F.lit(1)).join(
        psi_row.withColumn("k", F.lit(1)), on="k", how="left")
    change = F.abs(
        F.coalesce(c("c_harmful_rate"), F.lit(0.0)) - F.coalesce(c("r_harmful_rate"), F.lit(0.0)))
    rules = [
        ("harmful_rate_drift", "high", change, K.HARMFUL_ALERT,
         F.concat(F.lit("Harmful rate changed by "), percent_text(change))),
        ("high_override_rate", "medium", c("c_override_rate"), K.OVERRIDE_ALERT,
         F.concat(F.lit("Analysts overriding "), percent_text(c("c_override_rate")),
                  F.lit(" of decisions"))),
        ("feature_score_missing_high", "low", c("c_feature_missing_rate"), K.MISSING_ALERT,
         F.concat(F.lit("Feature score unavailable (cross-medium/title) in "),
                  percent_text(c("c_feature_missing_rate")), F.lit(" of matches"))),
        ("score_distribution_drift", "high", c("psi"), K.PSI_ALERT,
         F.concat(F.lit("PSI on match_confidence = "),
                  F.format_string("%.3f", round_exact(c("psi"), 3)),
                  F.lit(f" (threshold {K.PSI_ALERT})"))),
    ]
    fired = F.array(*[
        F.when(v > limit, F.struct(
            F.lit(name).alias("type"), F.lit(level).alias("severity"),
            v.alias("value"), text.alias("message")))
        for name, level, v, limit, text in rules
    ])
    return one.select(F.explode(F.array_compact(fired)).alias("a")).select("a.*")


def drift_report(
    predictions: DataFrame, limit: int = K.RECENT_LIMIT
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(window metrics, psi, alerts) of the newest ``limit`` reviewed predictions.

    The log is read once; what follows works on those at most ``limit`` rows.
    """
    rows = small_table(windows(predictions, limit), limit)
    metrics, index = small_table(window_metrics(rows)), small_table(psi(rows))
    return metrics, index, alerts(metrics, index)


def report_rows(metrics: DataFrame, psi_row: DataFrame, fired: DataFrame) -> DataFrame:
    """The whole report as (section, item, value) rows."""
    names = [c for c in metrics.columns if c != "window"]
    values = metrics.select("window", *[F.col(c).cast("double").alias(c) for c in names]).unpivot(
        "window", names, "item", "value").withColumnRenamed("window", "section")
    index = psi_row.select(F.lit("drift").alias("section"), F.lit("psi").alias("item"),
                           F.col("psi").alias("value"))
    count = fired.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit("alerts").alias("section"), F.lit("alert_count").alias("item"), "value")
    each = fired.select(F.lit("alerts").alias("section"), F.col("type").alias("item"), "value")
    return values.unionByName(index).unionByName(count).unionByName(each)
