"""Readiness checks and report tables, each in one pass over the data."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import numeric as N
from ..functions.rounding import round_exact


class NotReady(ValueError):
    """Raised by the strict mode of the readiness checks."""


def _long(row: DataFrame, names: Sequence[tuple[str, str]], value: str) -> DataFrame:
    """One aggregate row with columns m0, m1, ... to long (check, column, value) form."""
    cells = F.array(*[
        F.struct(F.lit(a).alias("check"), F.lit(b).alias("column"), F.col(f"m{i}").alias(value))
        for i, (a, b) in enumerate(names)
    ])
    return row.select(F.explode(cells).alias("c")).select("c.*")


def readiness_checks(
    frame: DataFrame, numeric: Sequence[str] = (), text: Sequence[str] = K.TEXT_COLUMNS
) -> DataFrame:
    """Violations per check as (check, column, violations).

    Value checks are one aggregate without a shuffle of rows. The key check shuffles ids only, and
    copies of a hot key are counted inside each map task first.
    """
    wanted = [*(numeric or K.numeric_features()), *text]
    absent = [c for c in wanted if c not in frame.columns]

    def violations(c: str) -> Column:
        if c in absent:
            return F.lit(1).cast("long")
        bad = F.col(c).isNull() if c in text else N.not_finite(F.col(c).cast("double"))
        return F.coalesce(F.sum(bad.cast("long")), F.lit(0))

    checks = [("not_empty", "*", (F.count(F.lit(1)) == 0).cast("long"))]
    outside = ~F.coalesce(F.col(K.TARGET).isin(0, 1), F.lit(False))
    checks.append(("label_domain", K.TARGET, F.coalesce(F.sum(outside.cast("long")), F.lit(0))))
    for c in wanted:
        kind = "column_exists" if c in absent else "text_present" if c in text else "finite"
        checks.append((kind, c, violations(c)))
    row = frame.agg(*[e.alias(f"m{i}") for i, (_, _, e) in enumerate(checks)])
    values = _long(row, [(kind, c) for kind, c, _ in checks], "violations")
    copies = frame.groupBy("video_id").agg((F.count(F.lit(1)) - 1).alias("extra")).agg(
        F.coalesce(F.sum("extra"), F.lit(0)).alias("m0")
    )
    return values.unionByName(_long(copies, [("unique_key", "video_id")], "violations"))


def require_ready(checks: DataFrame) -> None:
    """Raise with every failed check, not only the first."""
    failed = checks.where(F.col("violations") > 0).collect()
    if failed:
        raise NotReady("; ".join(f"{r['check']}({r['column']})={r['violations']}" for r in failed))


def class_counts(frame: DataFrame) -> DataFrame:
    """Rows per split and label, plus the overall counts as split 'all'."""
    per_split = frame.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"))
    both = F.explode(F.array(F.col("split"), F.lit("all"))).alias("split")
    return per_split.select(both, "label", "n").groupBy("split", "label").agg(
        F.sum("n").alias("n")
    )


def imputation_summary(frame: DataFrame) -> DataFrame:
    flags = [c for c in frame.columns if c.endswith("_was_missing")]
    row = frame.agg(*[
        F.struct(F.sum(c).cast("long").alias("count"), F.avg(c).alias("rate")).alias(f"m{i}")
        for i, c in enumerate(flags)
    ])
    names = [("imputed", c.removesuffix("_was_missing")) for c in flags]
    return _long(row, names, "m").select(
        F.col("column").alias("feature"),
        F.col("m.count").alias("imputed_count"),
        round_exact(F.col("m.rate"), 4).alias("imputed_rate"),
    )


# fixed values: counts of the report that are also given as a share of all rows
_RATES = {"ocr_text_rows": "has_ocr_text_rate", "asr_text_rows": "has_asr_text_rate",
          "imputed_count": "imputed_rate"}


def quality_report(frame: DataFrame) -> DataFrame:
    """Long report (metric, item, value) over a frame with a ``split`` column, one pass."""
    flags = [c for c in frame.columns if c.endswith("_was_missing")]
    slim = frame.groupBy("snapshot_date", "split", "label").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(c).alias(c) for c in ("has_ocr_text", "has_asr_text", *flags)],
    )
    cells = [
        ("total_videos", F.lit(""), F.col("n")),
        ("split_size", F.col("split"), F.col("n")),
        ("label_overall", F.col("label").cast("string"), F.col("n")),
        ("label_per_split", F.concat_ws(":", "split", "label"), F.col("n")),
        ("snapshot", F.col("snapshot_date"), F.col("n")),
        ("ocr_text_rows", F.lit(""), F.col("has_ocr_text")),
        ("asr_text_rows", F.lit(""), F.col("has_asr_text")),
        *[("imputed_count", F.lit(c.removesuffix("_was_missing")), F.col(c)) for c in flags],
    ]
    counts = slim.select("n", F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), i.alias("item"), v.cast("double").alias("value"))
        for m, i, v in cells
    ])).alias("c")).groupBy("c.metric", "c.item").agg(
        F.sum("c.value").alias("value"), F.sum("n").alias("rows")
    )
    rate_name = F.element_at(
        F.create_map(*[F.lit(x) for kv in _RATES.items() for x in kv]), F.col("metric")
    )
    both = F.array_compact(F.array(
        F.struct("metric", "value"),
        F.when(rate_name.isNotNull(), F.struct(
            rate_name.alias("metric"), round_exact(F.col("value") / F.col("rows"), 4).alias("value")
        )),
    ))
    report = counts.select("item", F.explode(both).alias("r")).select(
        F.col("r.metric").alias("metric"), "item", F.col("r.value").alias("value")
    )
    n_features = len([c for c in frame.columns if c not in ("label", "label_def", "split")])
    widths = frame.sparkSession.range(1).select(F.explode(F.array(
        F.struct(F.lit("n_features").alias("metric"), F.lit(float(n_features)).alias("value")),
        F.struct(F.lit("n_numeric_features").alias("metric"),
                 F.lit(float(len(K.numeric_features()))).alias("value")),
    )).alias("r")).select("r.metric", F.lit("").alias("item"), "r.value")
    return report.unionByName(widths)


def row_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n"))
