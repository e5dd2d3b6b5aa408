"""Evaluation of a rule-based predictor and reports over rule-scored users."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.operators import evaluate, reports
from tidemark.plans.inputs import (
    ROLLUP_SQL,
    RULE_SQL,
    SCORED_USERS_SQL,
    order_rollup,
    rounded,
    rule_scores,
    scored_users,
    table,
)
from tidemark.plans.registry import query

REPORT_TIME = "2026-01-05 08:15:00"


def _rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_scores(order_rollup(table(spark, sf_dir, "lineitem")))


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_users(table(spark, sf_dir, "events"))


@query(
    "regression_metrics",
    f"""WITH {ROLLUP_SQL}, p AS (SELECT total_price AS y, sum_qty * 1500.0::DOUBLE AS f FROM rollup)
SELECT round(avg(abs(y - f)), 4) AS mae, round(avg((y - f) * (y - f)), 0) AS mse,
       round(1 - sum((y - f) * (y - f)) / sum((y - m) * (y - m)), 6) AS r2
FROM p, (SELECT avg(y) AS m FROM p)""",
)
def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = order_rollup(table(spark, sf_dir, "lineitem")).select(
        F.col("total_price").alias("label"), (F.col("sum_qty") * 1500.0).alias("prediction")
    )
    metrics = evaluate.regression_metrics(scored)
    return metrics.select(F.round("mae", 4).alias("mae"), F.round("mse", 0).alias("mse"), F.round("r2", 6).alias("r2"))


@query("accuracy", f"WITH {RULE_SQL} SELECT round(avg(CAST(label = prediction AS DOUBLE)), 6) AS accuracy FROM scored")
def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.accuracy(_rule(spark, sf_dir)), "accuracy")


@query(
    "confusion_matrix",
    f"WITH {RULE_SQL} "
    + " UNION ALL ".join(
        f"SELECT {a} AS actual, {p} AS predicted, count(*) FILTER (WHERE label = {a} AND prediction = {p}) AS n FROM scored"
        for a in (0, 1)
        for p in (0, 1)
    ),
)
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion_matrix(_rule(spark, sf_dir))


_METRICS = ("precision", "recall", "f1")


@query(
    "classification_report",
    f"""WITH {RULE_SQL},
classes AS (SELECT c, count(*) FILTER (WHERE label = c AND prediction = c) AS hit,
                   count(*) FILTER (WHERE prediction = c) AS predicted, count(*) FILTER (WHERE label = c) AS support
            FROM scored, (VALUES (0), (1)) AS v(c) GROUP BY c),
rates AS (SELECT c, support, hit, coalesce(hit / nullif(predicted, 0)::DOUBLE, 0) AS p,
                 coalesce(hit / nullif(support, 0)::DOUBLE, 0) AS r FROM classes),
per_class AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f FROM rates),
report AS (
  SELECT CAST(c AS VARCHAR) AS class, p AS "precision", r AS recall, f AS f1, support FROM per_class
  UNION ALL SELECT 'accuracy', NULL, NULL, sum(hit) / sum(support)::DOUBLE, CAST(sum(support) AS BIGINT) FROM per_class
  UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), CAST(sum(support) AS BIGINT) FROM per_class
  UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
                   sum(f * support) / sum(support), CAST(sum(support) AS BIGINT) FROM per_class)
SELECT class, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1, support
FROM report""",
)
def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.classification_report(_rule(spark, sf_dir)), *_METRICS)


# A prediction by rule of a column with three classes, one of which the rule never gives.
_FLAG_SQL = """flags AS (
  SELECT l_returnflag AS label, CASE WHEN l_quantity > 25 THEN 'N' WHEN l_tax > 0.04 THEN 'A' ELSE 'X' END AS prediction
  FROM lineitem),
cells AS (SELECT label AS actual, prediction AS predicted, count(*) AS n FROM flags GROUP BY ALL),
names AS (SELECT actual AS c FROM cells UNION SELECT predicted FROM cells)"""


def _flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    guess = F.when(F.col("l_quantity") > 25, "N").when(F.col("l_tax") > 0.04, "A").otherwise("X")
    return table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("label"), guess.alias("prediction"))


@query(
    "confusion_three_classes",
    f"""WITH {_FLAG_SQL}
SELECT a.c AS actual, p.c AS predicted, coalesce(n, 0) AS n
FROM names a CROSS JOIN names p LEFT JOIN cells ON actual = a.c AND predicted = p.c""",
)
def confusion_three_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion_matrix(_flags(spark, sf_dir))


@query(
    "report_three_classes",
    f"""WITH {_FLAG_SQL},
rates AS (
  SELECT c, support, hit, coalesce(hit / nullif(predicted, 0)::DOUBLE, 0) AS p, coalesce(hit / nullif(support, 0)::DOUBLE, 0) AS r
  FROM (SELECT c, coalesce(sum(n) FILTER (WHERE actual = c AND predicted = c), 0) AS hit,
               coalesce(sum(n) FILTER (WHERE predicted = c), 0) AS predicted,
               coalesce(sum(n) FILTER (WHERE actual = c), 0) AS support FROM names, cells GROUP BY c)),
per_class AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f FROM rates),
report AS (
  SELECT c AS class, p AS "precision", r AS recall, f AS f1, CAST(support AS BIGINT) AS support FROM per_class
  UNION ALL SELECT 'accuracy', NULL, NULL, sum(hit) / sum(support)::DOUBLE, CAST(sum(support) AS BIGINT) FROM per_class
  UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), CAST(sum(support) AS BIGINT) FROM per_class
  UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
                   sum(f * support) / sum(support), CAST(sum(support) AS BIGINT) FROM per_class)
SELECT class, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM report""",
)
def report_three_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.classification_report(_flags(spark, sf_dir)), *_METRICS)


_ROC_SQL = f"""WITH {RULE_SQL},
steps AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg
          FROM scored GROUP BY score),
sums AS (SELECT score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
                sum(pos) OVER () AS p, sum(neg) OVER () AS n
         FROM steps WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""


@query(
    "roc_curve",
    _ROC_SQL
    + """ SELECT NULL::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL SELECT round(score, 9), round(fp / n::DOUBLE, 6), round(tp / p::DOUBLE, 6) FROM sums""",
)
def roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = evaluate.roc_curve(_rule(spark, sf_dir), drop_intermediate=False)
    return rounded(rounded(points, "fpr", "tpr"), "threshold", digits=9)


@query(
    "roc_corners",
    _ROC_SQL
    + """, marked AS (SELECT *, lead(pos) OVER w AS pos_next, lead(neg) OVER w AS neg_next, row_number() OVER w AS place
                      FROM sums WINDOW w AS (ORDER BY score DESC))
SELECT NULL::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL SELECT round(score, 9), round(fp / n::DOUBLE, 6), round(tp / p::DOUBLE, 6) FROM marked
WHERE place = 1 OR pos_next IS NULL OR pos_next <> pos OR neg_next <> neg""",
)
def roc_corners(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = evaluate.roc_curve(_rule(spark, sf_dir))
    return rounded(rounded(points, "fpr", "tpr"), "threshold", digits=9)


@query(
    "roc_auc",
    _ROC_SQL + " SELECT round(sum(neg * (tp - pos / 2.0::DOUBLE)) / (max(p) * max(n)::DOUBLE), 6) AS roc_auc FROM sums",
)
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.roc_auc(_rule(spark, sf_dir)), "roc_auc")


@query(
    "score_report",
    f"""WITH {SCORED_USERS_SQL}
SELECT round(avg(note), 6) AS mean_note, round(median(note), 6) AS median_note, round(stddev_pop(note), 6) AS sd_note,
       round(min(note), 6) AS min_note, round(max(note), 6) AS max_note,
       round(avg(reussite) * 100, 6) AS success_rate, round(avg(proba), 6) AS mean_proba, count(*) AS n_entities
FROM users""",
)
def score_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = reports.score_report(_users(spark, sf_dir))
    return rounded(report, *[c for c in report.columns if c != "n_entities"])


SCORE_ROWS_SQL = f"""WITH {SCORED_USERS_SQL}
SELECT pseudo, note, printf('%.2f', note) AS note_text,
       CASE WHEN reussite = 1 THEN 'Réussi' ELSE 'Échec' END || ' (' || printf('%.1f', proba * 100) || '%)' AS status_text
FROM users"""


@query("score_rows", SCORE_ROWS_SQL)
def score_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.score_rows(_users(spark, sf_dir))


_SUMMARY_SQL_VALUES = (
    f"max('{REPORT_TIME}')",
    "max('analyst')",
    "CAST(count(*) AS VARCHAR)",
    "printf('%.2f', avg(note))",
    "printf('%.2f', min(note))",
    "printf('%.2f', max(note))",
    "printf('%.1f', avg(reussite) * 100) || '%'",
    "printf('%.1f', avg(proba) * 100) || '%'",
)

SUMMARY_SQL = f"WITH {SCORED_USERS_SQL} " + " UNION ALL ".join(
    "SELECT {} AS position, '{}' AS information, {} AS value FROM users".format(i, name.replace("'", "''"), value)
    for i, (name, value) in enumerate(zip(fixed.SUMMARY_LABELS, _SUMMARY_SQL_VALUES, strict=True), start=1)
)


@query("score_summary", SUMMARY_SQL)
def score_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    moment = F.lit(REPORT_TIME).cast("timestamp_ntz")
    return reports.summary_table(_users(spark, sf_dir), "analyst", moment)


@query("scores_in_order", f"SELECT row_number() OVER (ORDER BY pseudo) AS place, * FROM ({SCORE_ROWS_SQL})")
def scores_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.in_order(reports.score_rows(_users(spark, sf_dir)), "pseudo")


@query(
    "summary_now",
    f"""SELECT position, information, CASE WHEN position = 1 THEN 'true' ELSE value END AS value FROM ({SUMMARY_SQL})""",
)
def summary_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = reports.summary_table(_users(spark, sf_dir), "analyst")
    away = F.abs(F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("value", "yyyy-MM-dd HH:mm:ss"))
    return summary.withColumn("value", F.when(F.col("position") == 1, (away < 86400).cast("string")).otherwise(F.col("value")))
