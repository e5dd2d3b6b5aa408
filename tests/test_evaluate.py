"""Evaluation and reports against brute force."""

import math
import random
import statistics

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator

from tidemark.operators import evaluate, reports


@pytest.fixture(scope="module")
def scored():
    random.seed(7)
    rows = []
    for _ in range(700):
        label = random.randint(0, 1)
        score = round(min(1.0, max(0.0, random.gauss(0.4 + 0.2 * label, 0.2))), 2)
        rows.append((label, score, int(score >= 0.5)))
    return rows


@pytest.fixture(scope="module")
def table(spark, scored):
    return spark.createDataFrame(scored, "label int, score double, prediction int").repartition(3)


def brute_roc(rows):
    pos, neg = sum(label for label, *_ in rows), sum(1 - label for label, *_ in rows)
    points = [(0.0, 0.0)]
    for threshold in sorted({s for _, s, _ in rows}, reverse=True):
        tp = sum(1 for label, s, _ in rows if s >= threshold and label)
        fp = sum(1 for label, s, _ in rows if s >= threshold and not label)
        points.append((fp / neg, tp / pos))
    return points


def flat(points):
    return [x for point in points for x in point]


def test_roc_curve_keeps_all_points(table, scored):
    got = sorted((r.fpr, r.tpr) for r in evaluate.roc_curve(table, drop_intermediate=False).collect())
    assert flat(got) == pytest.approx(flat(sorted(brute_roc(scored))))


def test_roc_corners(table, scored):
    points = brute_roc(scored)[1:]
    pos, neg = sum(label for label, *_ in scored), sum(1 - label for label, *_ in scored)
    steps = [(round(f * neg), round(t * pos)) for f, t in points]
    kept = [(0.0, 0.0)]
    for i, point in enumerate(points):
        if i in (0, len(points) - 1):
            kept.append(point)
            continue
        bend = [steps[i + 1][k] - 2 * steps[i][k] + steps[i - 1][k] for k in (0, 1)]
        if any(bend):
            kept.append(point)
    got = sorted((r.fpr, r.tpr) for r in evaluate.roc_curve(table).collect())
    assert flat(got) == pytest.approx(flat(sorted(kept)))
    assert len(got) <= len(points) + 1


def test_roc_auc(table, scored):
    pos = [s for label, s, _ in scored if label]
    neg = [s for label, s, _ in scored if not label]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert evaluate.roc_auc(table).first().roc_auc == pytest.approx(want, abs=1e-12)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert evaluator.evaluate(table) == pytest.approx(want, abs=1e-9)


def test_roc_auc_of_one_class_is_missing(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.3)], "label int, score double")
    assert evaluate.roc_auc(df).first().roc_auc is None


def test_confusion_and_report(table, scored):
    n = {(a, p): sum(1 for label, _, q in scored if (label, q) == (a, p)) for a in (0, 1) for p in (0, 1)}
    got = {(r.actual, r.predicted): r.n for r in evaluate.confusion_matrix(table).collect()}
    assert got == n
    report = {r["class"]: r for r in evaluate.classification_report(table).collect()}
    f1 = {}
    for c in (0, 1):
        precision = n[c, c] / (n[0, c] + n[1, c])
        recall = n[c, c] / (n[c, 0] + n[c, 1])
        f1[c] = 2 * precision * recall / (precision + recall)
        assert (report[str(c)].precision, report[str(c)].recall, report[str(c)].f1) == pytest.approx(
            (precision, recall, f1[c])
        )
        assert report[str(c)].support == n[c, 0] + n[c, 1]
    correct = (n[0, 0] + n[1, 1]) / len(scored)
    assert report["accuracy"].f1 == pytest.approx(correct)
    assert evaluate.accuracy(table).first().accuracy == pytest.approx(correct)
    assert report["macro avg"].f1 == pytest.approx((f1[0] + f1[1]) / 2)
    weights = [n[c, 0] + n[c, 1] for c in (0, 1)]
    assert report["weighted avg"].f1 == pytest.approx((f1[0] * weights[0] + f1[1] * weights[1]) / len(scored))


def test_absent_classes_are_zero(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "label int, prediction int")
    assert {r.n for r in evaluate.confusion_matrix(df, classes=(0, 1)).collect()} == {0, 2}
    report = {r["class"]: r for r in evaluate.classification_report(df, classes=(0, 1)).collect()}
    assert (report["1"].precision, report["1"].recall, report["1"].f1, report["1"].support) == (0.0, 0.0, 0.0, 0)


def test_three_classes(spark):
    rows = [(0, 0), (0, 1), (1, 1), (2, 2), (2, 0), (2, 2)]
    df = spark.createDataFrame(rows, "label int, prediction int")
    report = {r["class"]: r for r in evaluate.classification_report(df, classes=(0, 1, 2)).collect()}
    assert (report["2"].precision, report["2"].recall) == pytest.approx((1.0, 2 / 3))
    assert report["accuracy"].support == 6


def test_regression_metrics(spark):
    random.seed(8)
    rows = [(y, y + random.gauss(0, 2)) for y in (random.uniform(0, 50) for _ in range(200))]
    df = spark.createDataFrame(rows, "label double, prediction double")
    got = evaluate.regression_metrics(df).first()
    for metric in ("mae", "mse", "r2"):
        assert got[metric] == pytest.approx(RegressionEvaluator(metricName=metric).evaluate(df))


@pytest.mark.parametrize(("prediction", "r2"), [(3.0, 1.0), (4.0, 0.0)])
def test_r2_of_a_constant_label(spark, prediction, r2):
    df = spark.createDataFrame([(3.0, prediction), (3.0, prediction)], "label double, prediction double")
    assert evaluate.regression_metrics(df).first().r2 == r2


def entities(spark):
    rows = [("a", 12.345, 1, 0.875), ("b", 8.5, 0, 0.125), ("c", 20.0, 1, 0.9995), ("d", 8.5, 0, 0.3)]
    return rows, spark.createDataFrame(rows, "pseudo string, note double, reussite int, proba double")


def test_score_rows(spark):
    rows, df = entities(spark)
    got = {r.pseudo: (r.note_text, r.status_text) for r in reports.score_rows(df).collect()}
    assert got == {p: (f"{n:.2f}", f"{'Réussi' if c == 1 else 'Échec'} ({q:.1%})") for p, n, c, q in rows}


def test_score_report(spark):
    rows, df = entities(spark)
    notes = [n for _, n, _, _ in rows]
    got = reports.score_report(df).first()
    assert got.mean_note == pytest.approx(statistics.mean(notes))
    assert got.median_note == pytest.approx(statistics.median(notes))
    assert got.sd_note == pytest.approx(statistics.pstdev(notes))
    assert (got.min_note, got.max_note, got.n_entities) == (8.5, 20.0, 4)
    assert got.success_rate == 50.0
    assert math.isclose(got.mean_proba, statistics.mean(q for *_, q in rows))


def test_summary_table(spark):
    _, df = entities(spark)
    table = {r.position: (r.information, r.value) for r in reports.summary_table(df, "me").collect()}
    assert len(table) == 8
    assert table[3] == ("Nombre d'étudiants", "4")
    assert table[7] == ("Taux de réussite", "50.0%")


def test_no_class_is_dropped(spark):
    rows = [(0, 0), (1, 1), (2, 2), (2, 0), (1, 3), (None, 1), (1, None)]
    df = spark.createDataFrame(rows, "label int, prediction int")
    cells = {(r.actual, r.predicted): r.n for r in evaluate.confusion_matrix(df, classes=[7]).collect()}
    assert len(cells) == 25 and sum(cells.values()) == 5 and cells[1, 3] == 1 and cells[7, 7] == 0
    report = {r["class"]: r for r in evaluate.classification_report(df).collect()}
    assert set(report) == {"0", "1", "2", "3", "accuracy", "macro avg", "weighted avg"}
    assert report["accuracy"].f1 == pytest.approx(0.6) and report["accuracy"].support == 5
    assert (report["3"].precision, report["3"].support) == (0.0, 0)
