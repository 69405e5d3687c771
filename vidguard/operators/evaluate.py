"""Classification metrics, AUC, overfit check and promotion gate."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.rounding import round_exact
from .skew import running_total

METRICS = ("accuracy", "f1", "recall", "precision", "roc_auc")
AUC_BUCKETS = 256


def confusion_counts(df: DataFrame) -> DataFrame:
    """tp, fp, fn, tn per split from columns split, label, pred."""
    y, p = F.col("label") == 1, F.col("pred") == 1

    def count(cond: Column) -> Column:
        return F.count_if(cond)

    return df.groupBy("split").agg(
        count(y & p).alias("tp"), count(~y & p).alias("fp"),
        count(y & ~p).alias("fn"), count(~y & ~p).alias("tn"),
    )


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def _scores(tp: Column, fp: Column, fn: Column) -> tuple[Column, Column, Column]:
    """precision, recall, f1 with 0.0 for an empty denominator."""
    return (_ratio(tp, tp + fp), _ratio(tp, tp + fn), _ratio(2.0 * tp, 2 * tp + fp + fn))


def roc_auc(df: DataFrame) -> DataFrame:
    """AUC per split from label and score: P(positive above negative), ties counting half.

    Works on counts per distinct score; negatives below come from a running total
    over buckets cut at quantiles of the distinct scores.
    A split with a single class has no AUC (NULL).
    """
    per_score = df.groupBy("split", "score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg"))
    # cut points among the distinct scores, so buckets stay even however scores bunch
    shares = F.array(*[F.lit(i / AUC_BUCKETS) for i in range(1, AUC_BUCKETS)])
    cuts = per_score.groupBy("split").agg(F.percentile_approx("score", shares).alias("cuts"))
    placed = per_score.join(cuts, on="split").withColumn(
        "bucket", F.size(F.filter("cuts", lambda c: c < F.col("score")))).drop("cuts")
    ranked = running_total(placed, ["split"], "bucket", [F.col("score")], "neg", "upto")
    wins = F.col("pos") * (F.col("upto") - F.col("neg") / 2.0)
    totals = ranked.groupBy("split").agg(
        F.sum(wins).alias("wins"), F.sum("pos").alias("p"), F.sum("neg").alias("n")
    )
    pairs = F.col("p").cast("double") * F.col("n")
    return totals.select(
        "split", F.when(pairs > 0, round_exact(F.col("wins") / pairs, 4)).alias("roc_auc")
    )


def metrics(df: DataFrame) -> DataFrame:
    """One row per split: accuracy, f1, recall, precision, roc_auc and sample counts."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    precision, recall, f1 = _scores(tp, fp, fn)
    n = tp + fp + fn + tn
    rows = confusion_counts(df).select(
        "split",
        round_exact(_ratio(tp + tn, n), 4).alias("accuracy"), round_exact(f1, 4).alias("f1"),
        round_exact(recall, 4).alias("recall"), round_exact(precision, 4).alias("precision"),
        n.alias("n_samples"), (tp + fn).alias("n_positive"), (fp + tn).alias("n_negative"),
    )
    return rows.join(roc_auc(df), on="split", how="left")


def confusion_matrix(df: DataFrame) -> DataFrame:
    """Four cells per split, zero cells included."""
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    return confusion_counts(df).select("split", F.explode(F.array(*[
        F.struct(F.lit(y).alias("label"), F.lit(p).alias("pred"), F.col(c).alias("n"))
        for y, p, c in cells
    ])).alias("c")).select("split", "c.*")


def class_report(df: DataFrame) -> DataFrame:
    """Precision, recall, f1, support per class plus accuracy, macro and weighted averages."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def row(name: str, scores: tuple[Column, Column, Column], support: Column) -> Column:
        p, r, f = (round_exact(c, 4) for c in scores)
        return F.struct(F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1"), support.alias("support"))

    clean, harmful = _scores(tn, fn, fp), _scores(tp, fp, fn)
    n_clean, n_harmful = tn + fp, tp + fn
    total = n_clean + n_harmful
    macro = tuple((a + b) / 2.0 for a, b in zip(clean, harmful))
    weighted = tuple((a * n_clean + b * n_harmful) / total for a, b in zip(clean, harmful))
    accuracy = _ratio(tp + tn, total)
    return confusion_counts(df).select("split", F.explode(F.array(
        row("clean", clean, n_clean), row("harmful", harmful, n_harmful),
        row("accuracy", (accuracy, accuracy, accuracy), total),
        row("macro avg", macro, total), row("weighted avg", weighted, total),
    )).alias("r")).select("split", "r.*")


def metric_rows(table: DataFrame) -> DataFrame:
    return table.unpivot("split", list(METRICS), "metric", "value")


def overfit_gaps(table: DataFrame) -> DataFrame:
    """Train minus validation per metric; the flag is strict."""
    rows = metric_rows(table).where(F.col("split").isin("train", "val"))
    gaps = rows.groupBy("metric").agg(
        F.max(F.when(F.col("split") == "train", F.col("value"))).alias("train"),
        F.max(F.when(F.col("split") == "val", F.col("value"))).alias("val"),
    )
    gap = F.col("train") - F.col("val")
    return gaps.select("metric", "train", "val", round_exact(gap, 4).alias("gap"),
                       (gap > K.OVERFIT_GAP).alias("overfit"))


def promotion_gate(table: DataFrame) -> DataFrame:
    """Pass or fail of the validation recall and precision thresholds."""
    recall, precision = F.col("recall") >= K.MIN_RECALL, F.col("precision") >= K.MIN_PRECISION
    return table.where(F.col("split") == "val").select(
        "recall", "precision", recall.alias("passes_recall"),
        precision.alias("passes_precision"), (recall & precision).alias("promote"),
    )


def accuracy(df: DataFrame) -> DataFrame:
    return df.agg(F.avg((F.col("pred") == F.col("label")).cast("double")).alias("accuracy"))
