"""Prediction log views, review queue, candidate rows, text divergence."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.edits import text_difference
from ..functions.rounding import round_exact
from ..schemas import CANDIDATES
from .skew import latest_per_key, lookup_join, wide_lookup_join

NO_TEXT = "—"


def latest_verdicts(verdicts: DataFrame) -> DataFrame:
    """Last verdict of each video; equal times are ordered by id."""
    return latest_per_key(
        verdicts.select("video_id", "reviewed_at", "id", "verdict", "reviewed_by"),
        ["video_id"], ["reviewed_at", "id"],
    )


def with_verdicts(predictions: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Predictions with the verdict in force.

    A verdict covers the predictions that exist when it is given, and a later one replaces it. So
    only the last verdict of a video can apply, and it applies to what was logged up to then: one
    lookup instead of pairing all predictions of a video with all its verdicts.
    """
    last = latest_verdicts(verdicts).select(
        "video_id", F.col("verdict").alias("_verdict"), F.col("reviewed_by").alias("_by"),
        F.col("reviewed_at").alias("_at"),
    )
    joined = lookup_join(predictions, last, "video_id", "id") if _is_text(predictions) else (
        predictions.join(last, on="video_id", how="left"))
    applies = F.col("_at") >= F.col("created_at")
    return joined.withColumns({
        "reviewer_verdict": F.when(applies, F.col("_verdict")),
        "reviewed_by": F.when(applies, F.col("_by")),
        "reviewed_at": F.when(applies, F.col("_at")),
    }).drop("_verdict", "_by", "_at")


def _is_text(df: DataFrame) -> bool:
    return dict(df.dtypes)["video_id"] == "string"


def review_queue(
    records: DataFrame, decisions: Sequence[str] = (K.REVIEW,)
) -> DataFrame:
    """Rows with one of the decisions; an empty choice keeps all."""
    return records.where(F.col("decision").isin(*decisions)) if decisions else records


def queue_size(records: DataFrame, decisions: Sequence[str] = (K.REVIEW,)) -> DataFrame:
    return review_queue(records, decisions).agg(F.count(F.lit(1)).alias("videos_in_queue"))


def distribution(records: DataFrame) -> DataFrame:
    """Counts by decision (NULL left out), duplicate type and lane (NULL kept)."""
    names = ("decision", "duplicate_type", "lane")
    counts = records.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    return counts.unpivot("n", list(names), "field", "value").where(
        (F.col("field") != "decision") | F.col("value").isNotNull()
    ).groupBy("field", "value").agg(F.sum("n").alias("n"))


def pair_mediums(pair: Column) -> tuple[Column, Column]:
    """('title', 'ocr') of 'q.title<->c.ocr'; anything malformed gives title twice."""
    good = pair.rlike(r"^[^.]*\..*<->[^.]*\.") & (
        F.size(F.split(pair, "<->")) == 2
    )
    left = F.split(F.split(pair, "<->")[0], r"\.", 2)
    right = F.split(F.split(pair, "<->")[1], r"\.", 2)
    fine = F.coalesce(good, F.lit(False))
    return (F.when(fine, F.get(left, F.lit(1))).otherwise("title"),
            F.when(fine, F.get(right, F.lit(1))).otherwise("title"))


def candidate_rows(records: DataFrame) -> DataFrame:
    """Candidate JSON back to ranked rows with the two mediums of each pair."""
    listed = records.select("video_id", F.posexplode(
        F.from_json("candidate_matches", CANDIDATES)).alias("pos", "c"))
    q_medium, c_medium = pair_mediums(F.col("pair"))
    return listed.select("video_id", (F.col("pos") + 1).alias("rank"), "c.*").withColumns({
        "q_medium": q_medium, "c_medium": c_medium,
    })


def split_texts(*splits: DataFrame) -> DataFrame:
    """Texts of all splits, one row per video: the first split that has it wins."""
    parts = [
        s.select("video_id", *[f"{m}_text" for m in K.MEDIUMS], F.lit(-i).alias("_order"))
        for i, s in enumerate(splits)
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return latest_per_key(out, ["video_id"], ["_order"]).drop("_order")


def matched_texts(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """The two texts behind each candidate; a missing one is shown as a dash."""
    named = texts.select("video_id", *[F.col(f"{m}_text").alias(m) for m in K.MEDIUMS]).unpivot(
        "video_id", list(K.MEDIUMS), "_medium", "_text").where(F.trim("_text") != "")
    shown = named.select(F.concat_ws(":", "_medium", "video_id").alias("_key"), "_text")

    def with_text(df: DataFrame, video: str, medium: str, out: str) -> DataFrame:
        keyed = df.withColumn("_key", F.concat_ws(":", medium, video))
        # one text per side travels; a seed that many rows name is spread over copies of its text
        found = wide_lookup_join(keyed, shown.withColumnRenamed("_text", out), "_key", "_row")
        return found.withColumn(out, F.coalesce(out, F.lit(NO_TEXT))).drop("_key")

    numbered = rows.withColumn("_row", F.xxhash64("video_id", "seed_id", "rank"))
    both = with_text(with_text(numbered, "video_id", "q_medium", "query_shown"),
                     "seed_id", "c_medium", "seed_shown")
    return both.drop("_row")


def divergence(df: DataFrame, a: str, b: str) -> DataFrame:
    """Edit distance of two texts and its share of the longer one.

    The distance costs length times length: meant for titles and captions, not for documents.
    """
    left, right = F.coalesce(F.col(a), F.lit("")), F.coalesce(F.col(b), F.lit(""))
    longest = F.greatest(F.length(left), F.length(right))
    return df.withColumn("edit_distance", F.levenshtein(left, right)).withColumn(
        "divergence", F.when(longest > 0, round_exact(F.col("edit_distance") / longest, 4))
        .otherwise(F.lit(0.0)))


def differences(df: DataFrame, a: str, b: str) -> DataFrame:
    """Adds edit_distance, divergence and runs: where the two texts differ, character by character.

    ``runs`` lists (kind, a_start, a_end, b_start, b_end) in order, with code points and exclusive
    ends; the characters between two runs are equal. Null texts are empty. Made for texts of any
    length: near ones cost their edits, others one bit operation per character and 64 characters.
    """
    left, right = F.coalesce(F.col(a), F.lit("")), F.coalesce(F.col(b), F.lit(""))
    longest = F.greatest(F.length(left), F.length(right))
    found = df.withColumn("_found", text_difference(F.col(a), F.col(b)))
    return found.withColumns({
        "edit_distance": F.col("_found.edit_distance"), "runs": F.col("_found.runs"),
        "divergence": F.when(longest > 0, round_exact(
            F.col("_found.edit_distance") / longest, 4)).otherwise(F.lit(0.0)),
    }).drop("_found")


def replayed(a: Column, b: Column, runs: Column) -> Column:
    """Text a with every run replaced by what b has there: b itself, if the runs are right."""
    first = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def piece(text: Column, start: Column, end: Column) -> Column:
        return F.substring(text, (start + 1).cast("int"), (end - start).cast("int"))

    def step(acc: Column, r: Column) -> Column:
        return F.struct(r["a_end"].alias("at"), F.concat(
            acc["out"], piece(a, acc["at"], r["a_start"]), piece(b, r["b_start"], r["b_end"])
        ).alias("out"))

    return F.aggregate(runs, first, step, lambda acc: F.concat(
        acc["out"], piece(a, acc["at"], F.length(a).cast("long"))))
