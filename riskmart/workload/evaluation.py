"""Metrics, curves, comparisons and the run table."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskmart.ml import selection
from riskmart.operators import metrics, runs
from riskmart.workload.registry import query
from riskmart.workload.standins import PREDICTIONS_SQL, RUNS_SQL, predictions, runs as run_table

_BY = ["model", "split"]


def _rounded(df, *names, digits=6):
    return df.withColumns({n: F.round(n, digits) for n in names})


_METRICS_SQL = f"""
SELECT model, split, tp, fp, fn, tn, (tp + tn)::DOUBLE / (tp + fp + fn + tn) AS accuracy,
       coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0) AS precision, coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0) AS recall,
       coalesce(2 * tp::DOUBLE / nullif(2 * tp + fp + fn, 0), 0) AS f1_score, n_unscored
FROM (SELECT model, split, count(*) FILTER (label = 1 AND prediction = 1) AS tp,
             count(*) FILTER (label = 0 AND prediction = 1) AS fp, count(*) FILTER (label = 1 AND prediction = 0) AS fn,
             count(*) FILTER (label = 0 AND prediction = 0) AS tn,
             count(*) FILTER (score IS NULL OR isnan(score)) AS n_unscored FROM p GROUP BY model, split)"""

_CURVE_SQL = """
SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY model, split) AS n_pos,
       sum(neg) OVER (PARTITION BY model, split) AS n_neg
FROM (SELECT model, split, score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg
      FROM p GROUP BY model, split, score)
WINDOW w AS (PARTITION BY model, split ORDER BY score DESC ROWS UNBOUNDED PRECEDING)"""

_AREAS_SQL = """
SELECT model, split, sum(neg * (tp - pos / 2.0::DOUBLE)) / (max(n_pos)::DOUBLE * max(n_neg)) AS auc_roc,
       sum(pos::DOUBLE / n_pos * (prec + coalesce(before, prec)) / 2.0::DOUBLE) AS auc_pr
FROM (SELECT *, tp::DOUBLE / (tp + fp) AS prec,
             lag(tp::DOUBLE / (tp + fp)) OVER (PARTITION BY model, split ORDER BY score DESC) AS before FROM c)
GROUP BY model, split"""


@query(
    "binary_metrics",
    f"""WITH p AS ({PREDICTIONS_SQL}), m AS ({_METRICS_SQL})
        SELECT model, split, tp, fp, fn, tn, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision,
               round(recall, 6) AS recall, round(f1_score, 6) AS f1_score, n_unscored FROM m""",
)
def binary_metrics(t):
    made = metrics.binary_metrics(predictions(t), _BY)
    return _rounded(made, "accuracy", "precision", "recall", "f1_score")


@query(
    "confusion_matrix",
    f"""WITH p AS ({PREDICTIONS_SQL}), g AS (SELECT DISTINCT model, split FROM p),
        cells AS (SELECT * FROM g, (VALUES (0), (1)) l(label), (VALUES (0), (1)) q(prediction))
        SELECT model, split, label, prediction, count(p.score) AS n_rows
        FROM cells LEFT JOIN p USING (model, split, label, prediction) GROUP BY ALL""",
)
def confusion_matrix(t):
    return metrics.confusion_matrix(predictions(t), _BY)


@query(
    "auc_roc_exact",
    f"""WITH p AS ({PREDICTIONS_SQL}), c AS ({_CURVE_SQL}), a AS ({_AREAS_SQL})
        SELECT model, split, round(auc_roc, 6) AS auc_roc FROM a""",
)
def auc_roc_exact(t):
    return _rounded(metrics.auc_roc(predictions(t), _BY), "auc_roc")


@query(
    "auc_pr_exact",
    f"""WITH p AS ({PREDICTIONS_SQL}), c AS ({_CURVE_SQL}), a AS ({_AREAS_SQL})
        SELECT model, split, round(auc_pr, 6) AS auc_pr FROM a""",
)
def auc_pr_exact(t):
    return _rounded(metrics.auc_pr(predictions(t), _BY), "auc_pr")


@query(
    "roc_points",
    f"""WITH p AS ({PREDICTIONS_SQL}), c AS ({_CURVE_SQL})
        SELECT model, split, score AS threshold, round(fp::DOUBLE / n_neg, 6) AS fpr, round(tp::DOUBLE / n_pos, 6) AS tpr
        FROM c UNION ALL SELECT DISTINCT model, split, NULL, 0.0::DOUBLE, 0.0::DOUBLE FROM p""",
)
def roc_points(t):
    return _rounded(metrics.roc_points(predictions(t), _BY), "fpr", "tpr")


def _thinned_sql(same: str) -> str:
    return f"""WITH p AS ({PREDICTIONS_SQL}), c AS ({_CURVE_SQL}),
            n AS (SELECT *, lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg, row_number() OVER w AS nth FROM c
                  WINDOW w AS (PARTITION BY model, split ORDER BY score DESC))
        SELECT model, split, score AS threshold, round(fp::DOUBLE / n_neg, 6) AS fpr, round(tp::DOUBLE / n_pos, 6) AS tpr
        FROM n WHERE nth = 1 OR next_pos IS NULL OR NOT ({same})
        UNION ALL SELECT DISTINCT model, split, NULL, 0.0::DOUBLE, 0.0::DOUBLE FROM p"""


@query("roc_points_thinned", _thinned_sql("pos = next_pos AND neg = next_neg"))
def roc_points_thinned(t):
    """The points that a plot of the curve needs: as drawn, with equal steps merged."""
    return _rounded(metrics.roc_points(predictions(t), _BY, thin="equal_steps"), "fpr", "tpr")


@query("roc_points_collinear", _thinned_sql("pos * next_neg = neg * next_pos"))
def roc_points_collinear(t):
    """Corners of the curve alone."""
    return _rounded(metrics.roc_points(predictions(t), _BY, thin="collinear"), "fpr", "tpr")


@query(
    "model_choice",
    f"""WITH p AS ({PREDICTIONS_SQL}), c AS ({_CURVE_SQL}), a AS ({_AREAS_SQL})
        SELECT model AS point, count(auc_roc) AS n_folds, round(avg(auc_roc), 6) AS area FROM a GROUP BY model
        ORDER BY avg(auc_roc) DESC, model LIMIT 1""",
)
def model_choice(t):
    """Best of the three models by the mean exact area over both parts, all measured in one job."""
    return _rounded(selection.best_point(predictions(t).withColumnsRenamed({"model": "point", "split": "fold"})), "area")


@query(
    "pr_points",
    f"""WITH p AS ({PREDICTIONS_SQL}), c AS ({_CURVE_SQL})
        SELECT model, split, score AS threshold, round(tp::DOUBLE / (tp + fp), 6) AS precision,
               round(tp::DOUBLE / n_pos, 6) AS recall
        FROM c UNION ALL SELECT DISTINCT model, split, NULL, 1.0::DOUBLE, 0.0::DOUBLE FROM p""",
)
def pr_points(t):
    return _rounded(metrics.pr_points(predictions(t), _BY), "precision", "recall")


def _side(split: str, prefix: str, names: tuple[str, ...]) -> str:
    return ", ".join(
        f"round(max(CASE WHEN split = '{split}' THEN {src} END), 6) AS {prefix}_{out}" for src, out in names
    )


@query(
    "model_comparison",
    f"""WITH p AS ({PREDICTIONS_SQL}), c AS ({_CURVE_SQL}), a AS ({_AREAS_SQL}), m AS ({_METRICS_SQL}),
        j AS (SELECT * FROM m JOIN a USING (model, split)),
        v AS (SELECT model,
            {_side('valid', 'val', (('accuracy', 'accuracy'), ('f1_score', 'f1'), ('auc_roc', 'auc_roc')))},
            {_side('test', 'test', (('accuracy', 'accuracy'), ('precision', 'precision'), ('recall', 'recall'),
                                    ('f1_score', 'f1'), ('auc_roc', 'auc_roc')))}
            , max(CASE WHEN split = 'valid' THEN n_unscored END) AS val_unscored,
            max(CASE WHEN split = 'test' THEN n_unscored END) AS test_unscored
            FROM j GROUP BY model)
        SELECT *, CAST(rank() OVER (ORDER BY test_auc_roc DESC, model) AS INTEGER) AS position FROM v""",
)
def model_comparison(t):
    made = metrics.model_comparison(predictions(t))
    return _rounded(made, *[n for n in made.columns if n not in ("model", "position") and not n.endswith("unscored")])


@query(
    "best_run",
    f"""WITH r AS ({RUNS_SQL})
        (SELECT 'valid_f1_score' AS metric, run_id, run_name, valid_f1_score AS value FROM r
         WHERE valid_f1_score IS NOT NULL ORDER BY valid_f1_score DESC, run_id DESC LIMIT 1)
        UNION ALL
        (SELECT 'valid_accuracy', run_id, run_name, valid_accuracy FROM r
         WHERE valid_accuracy IS NOT NULL ORDER BY valid_accuracy DESC, run_id DESC LIMIT 1)""",
)
def best_run(t):
    table = run_table(t)
    return runs.best_run(table, "valid_f1_score").unionByName(runs.best_run(table, "valid_accuracy"))


@query(
    "best_tags",
    f"""WITH r AS ({RUNS_SQL})
        SELECT run_id, coalesce(run_id = (SELECT run_id FROM r WHERE valid_f1_score IS NOT NULL
                                          ORDER BY valid_f1_score DESC, run_id DESC LIMIT 1), false) AS best_f1,
               coalesce(run_id = (SELECT run_id FROM r WHERE valid_accuracy IS NOT NULL
                                  ORDER BY valid_accuracy DESC, run_id DESC LIMIT 1), false) AS best_accuracy FROM r""",
)
def best_tags(t):
    table = run_table(t).withColumn("tags", F.lit(None).cast("map<string,string>"))
    tagged = runs.with_best_tags(table, {"best_f1": "valid_f1_score", "best_accuracy": "valid_accuracy"})
    return tagged.select(
        "run_id", *[F.coalesce(F.col("tags")[n] == "true", F.lit(False)).alias(n) for n in ("best_f1", "best_accuracy")]
    )


@query(
    "run_history",
    f"""WITH r AS ({RUNS_SQL})
        SELECT run_id, run_name, experiment, start_time, coalesce(valid_accuracy, 0) AS valid_accuracy,
               coalesce(valid_f1_score, 0) AS valid_f1_score, 0.0::DOUBLE AS test_accuracy FROM r""",
)
def run_history(t):
    return runs.run_history(run_table(t), ["valid_accuracy", "valid_f1_score", "test_accuracy"], "grants")


@query("experiments", "SELECT DISTINCT event_type AS experiment FROM events")
def experiments(t):
    return runs.experiments(t.events.withColumnRenamed("event_type", "experiment"))


@query(
    "topk_features",
    """SELECT p_name || ' / ' || p_type AS feature, max(p_retailprice) / 10000.0::DOUBLE AS importance FROM part
       GROUP BY ALL ORDER BY importance DESC, feature LIMIT 15""",
)
def topk_features(t):
    table = t.part.groupBy(F.concat_ws(" / ", "p_name", "p_type").alias("feature")).agg(
        (F.max("p_retailprice") / 10000.0).alias("importance")
    )
    return runs.topk_features(table)
