"""Queries over labels and scores."""

from __future__ import annotations

from tenura.operators import folds, gate, metrics
from tenura.plans.registry import query, rounded
from tenura.sources.views import view, with_views

S, B = with_views("scored"), with_views("big_scored")


@query("minmax_scores", B + """
    SELECT id, ROUND((score - (SELECT MIN(score) FROM big_scored)) /
           ((SELECT MAX(score) - MIN(score) FROM big_scored) + 1e-12), 6) AS scaled FROM big_scored""")
def minmax_scores(spark, folder):
    return rounded(metrics.minmax_scores(view(spark, folder, "big_scored"), "score").select("id", "scaled"))


def _auc(view_name: str) -> str:
    return f"""
    , ranks AS (SELECT y, RANK() OVER (ORDER BY score) + (COUNT(*) OVER (PARTITION BY score) - 1) / 2.0 AS r
                FROM {view_name}),
    sides AS (SELECT SUM(y) AS p, COUNT(*) - SUM(y) AS n, SUM(r) FILTER (y = 1) AS s FROM ranks)
    SELECT ROUND((s - p * (p + 1) / 2) / (p * n), 6) AS roc_auc FROM sides"""


def _ap(view_name: str) -> str:
    return f"""
    , per AS (SELECT score, SUM(y) AS pos, COUNT(*) AS n FROM {view_name} GROUP BY 1),
    run AS (SELECT pos, SUM(pos) OVER w AS tp, SUM(n) OVER w AS k FROM per WINDOW w AS (ORDER BY score DESC))
    SELECT ROUND(SUM(pos * CAST(tp AS DOUBLE) / k) / SUM(pos), 6) AS average_precision FROM run"""


@query("roc_auc", B + _auc("big_scored"))
def roc_auc(spark, folder):
    return rounded(metrics.roc_auc(view(spark, folder, "big_scored")))


@query("roc_auc_documents", S + _auc("scored"))
def roc_auc_documents(spark, folder):
    return rounded(metrics.roc_auc(view(spark, folder, "scored")))


@query("average_precision", B + _ap("big_scored"))
def average_precision(spark, folder):
    return rounded(metrics.average_precision(view(spark, folder, "big_scored")))


@query("average_precision_documents", S + _ap("scored"))
def average_precision_documents(spark, folder):
    return rounded(metrics.average_precision(view(spark, folder, "scored")))


_COUNTS = """SELECT {t}::DOUBLE AS threshold,
    CAST(COUNT(*) FILTER (score >= {t} AND y = 1) AS DOUBLE) AS tp,
    CAST(COUNT(*) FILTER (score >= {t} AND y = 0) AS DOUBLE) AS fp,
    CAST(COUNT(*) FILTER (score < {t} AND y = 1) AS DOUBLE) AS fn,
    CAST(COUNT(*) FILTER (score < {t} AND y = 0) AS DOUBLE) AS tn FROM big_scored"""
_SAFE = "CASE WHEN {b} = 0 THEN 0.0 ELSE ({a}) / ({b}) END"
_PREC, _REC = _SAFE.format(a="tp", b="tp + fp"), _SAFE.format(a="tp", b="tp + fn")
_F1 = _SAFE.format(a="2 * tp", b="2 * tp + fp + fn")


@query("threshold_metrics", B + ", c AS ("
       + " UNION ALL ".join(_COUNTS.format(t=t) for t in metrics.THRESHOLDS)
       + f") SELECT threshold, ROUND({_PREC}, 6) AS precision, ROUND({_REC}, 6) AS recall, ROUND({_F1}, 6) AS f1 FROM c")
def threshold_metrics(spark, folder):
    return rounded(metrics.threshold_metrics(view(spark, folder, "big_scored")))


@query("confusion_metrics", B + f""", c AS ({_COUNTS.format(t=0.5)})
    SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn,
           ROUND((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy, ROUND({_PREC}, 6) AS precision,
           ROUND({_REC}, 6) AS recall, ROUND({_F1}, 6) AS f1 FROM c""")
def confusion_metrics(spark, folder):
    return rounded(metrics.confusion_metrics(view(spark, folder, "big_scored")))


@query("prec_at_recall_floor", B + f""", c AS ({_COUNTS.format(t=0.3)})
    SELECT ROUND({_REC}, 6) AS recall,
           CASE WHEN {_REC} < 0.8 THEN 0.0 ELSE ROUND({_PREC}, 6) END AS prec_at_recall FROM c""")
def prec_at_recall_floor(spark, folder):
    return rounded(metrics.precision_at_recall_floor(view(spark, folder, "big_scored"), cut=0.3))


_FOLDS = """, folded AS (
    SELECT *, CAST((ROW_NUMBER() OVER (PARTITION BY y ORDER BY MD5('42:' || id), id) - 1) % 5 AS INT) AS fold
    FROM big_scored)"""


@query("stratified_folds", with_views("emb") + """
    SELECT id, y, CAST((ROW_NUMBER() OVER (
        PARTITION BY y ORDER BY MD5('42:' || CAST(id AS VARCHAR)), id) - 1) % 5 AS INT) AS fold FROM emb""")
def stratified_folds(spark, folder):
    return folds.stratified_folds(view(spark, folder, "emb"), "id").select("id", "y", "fold")


@query("cv_summary", B + _FOLDS + f""",
    c AS (SELECT fold, CAST(COUNT(*) FILTER (score >= 0.5 AND y = 1) AS DOUBLE) AS tp,
             CAST(COUNT(*) FILTER (score >= 0.5 AND y = 0) AS DOUBLE) AS fp,
             CAST(COUNT(*) FILTER (score < 0.5 AND y = 1) AS DOUBLE) AS fn,
             CAST(COUNT(*) FILTER (score < 0.5 AND y = 0) AS DOUBLE) AS tn FROM folded GROUP BY 1),
    per AS (SELECT fold, score, CAST(SUM(y) AS DOUBLE) AS pos, CAST(COUNT(*) AS DOUBLE) AS n
            FROM folded GROUP BY 1, 2),
    run AS (SELECT *, SUM(pos) OVER w AS tp, SUM(n) OVER w AS k FROM per
            WINDOW w AS (PARTITION BY fold ORDER BY score DESC)),
    curve AS (SELECT fold, SUM(pos * tp / k) / SUM(pos) AS average_precision,
                     SUM(pos * (SUM_N - (k - tp) + (n - pos) / 2)) / (SUM(pos) * MAX(SUM_N)) AS roc_auc
              FROM (SELECT *, SUM(n - pos) OVER (PARTITION BY fold) AS SUM_N FROM run) GROUP BY 1),
    long AS (SELECT 'accuracy' AS metric, (tp + tn) / (tp + fp + fn + tn) AS v FROM c
             UNION ALL SELECT 'precision', {_PREC} FROM c UNION ALL SELECT 'recall', {_REC} FROM c
             UNION ALL SELECT 'f1', {_F1} FROM c
             UNION ALL SELECT 'roc_auc', roc_auc FROM curve
             UNION ALL SELECT 'average_precision', average_precision FROM curve)
    SELECT metric, ROUND(AVG(v), 6) AS mean, ROUND(STDDEV_POP(v), 6) AS std FROM long GROUP BY 1""")
def cv_summary(spark, folder):
    folded = folds.stratified_folds(view(spark, folder, "big_scored"), "id")
    return rounded(metrics.cv_summary(metrics.all_metrics(folded, ["fold"])))


@query("gate_rank_scores", B + """
    SELECT id, CAST(gate >= 0.35 AS INT) AS side,
           ROUND(GREATEST(LEAST(CASE WHEN gate >= 0.35 THEN pos_score ELSE neg_score END, 1.0), 0.0), 6) AS fused
    FROM big_scored""")
def gate_rank_scores(spark, folder):
    return rounded(gate.gate_rank_scores(view(spark, folder, "big_scored")).select("id", "side", "fused"))


@query("gate_rank_predict", B + """
    , sided AS (SELECT id, CAST(gate >= 0.35 AS INT) AS side,
                       CASE WHEN gate >= 0.35 THEN pos_score ELSE neg_score END AS own FROM big_scored),
    ranked AS (SELECT id, side, ROW_NUMBER() OVER (
                   PARTITION BY side ORDER BY own DESC, MD5('0:' || id), id) AS rank,
                   COUNT(*) OVER (PARTITION BY side) AS n FROM sided)
    SELECT id, side, rank, CAST(rank <= FLOOR(CASE WHEN side = 1 THEN 0.25 ELSE 0.1 END * n) AS INT) AS prediction
    FROM ranked""")
def gate_rank_predict(spark, folder):
    return gate.gate_rank_predict(view(spark, folder, "big_scored"), "id").select("id", "side", "rank", "prediction")
