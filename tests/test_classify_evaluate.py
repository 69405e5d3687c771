import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from vidguard.operators import classify, encode, evaluate


def newton(x, y, c=1.0):
    """Optimum of the summed, class-balanced, L2-penalised logistic loss; intercept is free."""
    n = len(y)
    weight = np.where(y == 1, n / (2 * y.sum()), n / (2 * (n - y.sum())))
    a = np.hstack([x, np.ones((n, 1))])
    penalty = np.diag([1.0] * x.shape[1] + [0.0])
    w = np.zeros(a.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-a @ w))
        grad = penalty @ w + c * a.T @ (weight * (p - y))
        hess = penalty + c * (a.T * (weight * p * (1 - p))) @ a
        w = w - np.linalg.solve(hess, grad)
    return w


def test_training_reaches_the_same_optimum(spark, tmp_path):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(120, 5)) * [1, 3, 0.2, 5, 1] + 2
    x[:, 4] = 7.0  # constant
    y = (x[:, 0] + 0.3 * x[:, 1] + rng.normal(size=120) > 3.2).astype(int)
    x = x.astype(np.float32).astype(float)
    df = spark.createDataFrame([(f"v{i}", [float(a) for a in r], int(t))
                                for i, (r, t) in enumerate(zip(x, y))],
                               "video_id string, x array<float>, label int")
    model = classify.train(df)
    sd = x.std(axis=0)
    scaled = (x - x.mean(axis=0)) / np.where(sd == 0, 1, sd)
    want = newton(scaled, y)
    coef = classify.coefficients(model, [f"f{i}" for i in range(5)])
    got = [*coef.values(), model.stages[-1].intercept]
    assert np.allclose(got, want, atol=2e-3)
    shown = {}
    for r in classify.explain(model, df, [f"f{i}" for i in range(5)], top=3).collect():
        shown.setdefault(r["video_id"], []).append((r["rank"], r["feature"], r["contribution"]))
    for i, row in enumerate(scaled * np.array(list(coef.values()))):
        best = sorted(range(5), key=lambda k: -abs(row[k]))[:3]
        mine = sorted(shown[f"v{i}"])
        assert [m[1] for m in mine] == [f"f{k}" for k in best]
        assert np.allclose([m[2] for m in mine], row[best], atol=1e-6)
    scored = classify.predict(model, df)
    p = {r["video_id"]: r for r in scored.collect()}
    prob = 1 / (1 + np.exp(-(scaled @ want[:-1] + want[-1])))
    assert all(abs(p[f"v{i}"]["score"] - q) < 2e-3 for i, q in enumerate(prob))
    assert all(r["pred"] == int(r["score"] > 0.5) for r in p.values())
    assert set(scored.columns) == {"video_id", "x", "label", "score", "pred"}
    model.write().overwrite().save(str(tmp_path / "m"))
    again = classify.predict(PipelineModel.load(str(tmp_path / "m")), df)
    assert {r["video_id"]: r["score"] for r in again.collect()} == {
        k: r["score"] for k, r in p.items()}


def test_scaler_and_attributions(spark):
    df = spark.createDataFrame([("v1", 1.0, 5.0), ("v2", 3.0, 5.0), ("v3", 5.0, 5.0)],
                               "video_id string, a double, b double")
    stats = classify.collected_stats(classify.scaler_stats(df, ["a", "b"]))
    assert stats["a"] == (3.0, pytest.approx(np.std([1, 3, 5]))) and stats["b"] == (5.0, 1.0)
    rows = classify.attributions(df, {"a": 2.0, "b": 1.0}, stats, top=1).collect()
    assert [(r["video_id"], r["rank"], r["feature"]) for r in rows] == [
        ("v1", 1, "a"), ("v2", 1, "a"), ("v3", 1, "a")]
    assert rows[0]["contribution"] == pytest.approx(-2 * 2 / np.std([1, 3, 5]))


def test_model_matrix_order(spark):
    df = spark.createDataFrame([("v", [0.5, 0.25], 1.0, 2.0)],
                               "video_id string, vector array<float>, a double, b double")
    assert encode.model_matrix(df, ["b", "a"]).first()["x"] == [0.5, 0.25, 2.0, 1.0]


def brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    if not pos or not neg:
        return None
    return round(sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg), 4)


def test_metrics(spark):
    rng = np.random.default_rng(6)
    data = [(s, int(rng.random() < 0.4), float(rng.integers(0, 12)) / 11) for s in "ab"
            for _ in range(150)] + [("one", 0, 0.3), ("one", 0, 0.9)]
    df = spark.createDataFrame(data, "split string, label int, score double").withColumn(
        "pred", (F.col("score") > 0.5).cast("int"))
    for r in evaluate.metrics(df).collect():
        mine = [(y, s) for n, y, s in data if n == r["split"]]
        tp = sum(y == 1 and s > 0.5 for y, s in mine)
        fp = sum(y == 0 and s > 0.5 for y, s in mine)
        fn = sum(y == 1 and s <= 0.5 for y, s in mine)
        assert r["roc_auc"] == brute_auc(mine)
        assert r["precision"] == (round(tp / (tp + fp), 4) if tp + fp else 0.0)
        assert r["recall"] == (round(tp / (tp + fn), 4) if tp + fn else 0.0)
        assert r["f1"] == round(2 * tp / (2 * tp + fp + fn), 4)
        assert r["accuracy"] == round(sum((s > 0.5) == y for y, s in mine) / len(mine), 4)
        assert (r["n_samples"], r["n_positive"]) == (len(mine), sum(y for y, _ in mine))
    cells = evaluate.confusion_matrix(df.where("split = 'one'")).collect()
    assert {(r["label"], r["pred"]): r["n"] for r in cells} == {
        (0, 0): 1, (0, 1): 1, (1, 0): 0, (1, 1): 0}


def test_gate_and_gaps(spark):
    table = spark.createDataFrame(
        [("train", 0.99, 0.9, 1.0, 0.95, 0.99), ("val", 0.85, 0.85, 0.90, 0.85, 0.95)],
        "split string, accuracy double, f1 double, recall double, precision double, roc_auc double")
    assert evaluate.promotion_gate(table).first()["promote"] is True
    gaps = {r["metric"]: (r["gap"], r["overfit"]) for r in evaluate.overfit_gaps(table).collect()}
    assert gaps["accuracy"] == (0.14, True) and gaps["roc_auc"] == (0.04, False)
    low = table.withColumn("precision", F.lit(0.8499))
    assert evaluate.promotion_gate(low).first()["promote"] is False


def test_auc_of_scores_that_bunch(spark):
    """Scores within 1e-6 of each other still fall into many buckets, ties counting half."""
    rng = np.random.default_rng(6)
    score = 0.5 + rng.integers(0, 700, 3000) * 1e-9
    label = (rng.random(3000) < 0.3 + (score - 0.5) * 5e5).astype(int)
    df = spark.createDataFrame([("val", int(y), float(s)) for y, s in zip(label, score)],
                               "split string, label int, score double")
    pos, neg = score[label == 1], score[label == 0]
    want = (pos[:, None] > neg[None, :]).mean() + 0.5 * (pos[:, None] == neg[None, :]).mean()
    assert evaluate.roc_auc(df).first()["roc_auc"] == pytest.approx(want, abs=1e-4)


def test_gradient_is_that_of_the_objective(spark):
    """Near 0 at the fitted weights, away from it elsewhere; equal to plain sums."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 5)) * [1, 2, 3, 0.5, 1] + [0, 5, 0, 0, 1]
    y = (x[:, 0] - 0.5 * x[:, 1] + rng.normal(size=300) > -2).astype(int)
    df = spark.createDataFrame([(i, int(t), [float(v) for v in row])
                                for i, (row, t) in enumerate(zip(x, y))],
                               "video_id int, label int, x array<double>").repartition(3)
    model = classify.train(df)

    def plain(weights, bias):
        z = (x - x.mean(axis=0)) / x.std(axis=0)
        share = np.where(y == 1, 300 / (2 * y.sum()), 300 / (2 * (1 - y).sum()))
        slope = share * (1 / (1 + np.exp(-(z @ weights + bias))) - y)
        return [*((slope @ z + weights) / 300), slope.sum() / 300]

    def got(m):
        rows = {r.place: r.gradient for r in classify.objective_gradient(m, df).collect()}
        return [rows[i] for i in [0, 1, 2, 3, 4, -1]]

    fitted = model.stages[-1]
    assert max(map(abs, got(model))) < 1e-6
    assert got(model) == pytest.approx(plain(fitted.coefficients.toArray(), fitted.intercept), abs=1e-9)
    # another optimum: no penalty
    scaled = PipelineModel(model.stages[:-1]).transform(df.withColumn(
        "features_raw", array_to_vector(F.col("x"))))
    loose = LogisticRegression(featuresCol="features", labelCol="label").fit(scaled)
    other = PipelineModel([*model.stages[:-1], loose])
    assert got(other) == pytest.approx(plain(loose.coefficients.toArray(), loose.intercept), abs=1e-9)
    assert max(map(abs, got(other))) > 1e-3


def test_gradient_is_summed_without_a_row_per_input(spark):
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=(60, 5)), rng.integers(0, 2, 60)
    df = spark.createDataFrame([(f"v{i}", int(y[i]), [float(v) for v in x[i]]) for i in range(60)],
                               "video_id string, label int, x array<double>")
    model = classify.train(df)
    found = classify.objective_gradient(model, df)
    assert "Generate posexplode(z" not in found._jdf.queryExecution().optimizedPlan().toString()
    got = {r["place"]: r["gradient"] for r in found.collect()}
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    w, b = np.array(model.stages[-1].coefficients), float(model.stages[-1].intercept)
    weight = np.where(y == 1, 60 / (2 * y.sum()), 60 / (2 * (60 - y.sum())))
    slope = weight * (1 / (1 + np.exp(-(z @ w + b))) - y)
    want = {-1: slope.sum() / 60, **{i: (slope @ z[:, i] + w[i]) / 60 for i in range(5)}}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
