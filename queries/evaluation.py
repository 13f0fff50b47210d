"""Metrics on predictions from a fixed rule over all labelled documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.evaluation import (
    binary_metrics, classification_report, confusion_matrix, multiclass_metrics, predicted_binary,
    predicted_class, regression_metrics, task_summary,
)
from queries.registry import query, r6, table

JUDGED = """judged AS (
  SELECT d.doc_id, d.lang, d.n_chars::DOUBLE AS y_true, length(d.text) * 0.9::DOUBLE + 10 AS y_pred,
         l.quality AS truth, d.n_chars / (d.n_chars + 900.0::DOUBLE) AS p, l.quality + l.toxic AS cls
  FROM documents d JOIN labels l USING (doc_id)),
classed AS (
  SELECT *, (1 - p) * 0.6 AS p0, p * 0.7 AS p1, 1 - (1 - p) * 0.6 - p * 0.7 AS p2 FROM judged),
guessed AS (
  SELECT *, CAST(p > 0.5 AS INT) AS guess, CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END AS gcls,
         CASE cls WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END AS pcls FROM classed)"""


def _judged(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    p = F.col("n_chars") / (F.col("n_chars") + 900.0)
    second, first = p * 0.7, (1 - p) * 0.6
    return documents.join(table(spark, sf_dir, "labels"), "doc_id").select(
        "doc_id",
        "lang",
        F.col("n_chars").cast("double").alias("y_true"),
        (F.char_length("text") * 0.9 + 10).cast("double").alias("y_pred"),
        F.col("quality").alias("truth"),
        p.alias("p"),
        (F.col("quality") + F.col("toxic")).alias("cls"),
        F.array(first, second, 1 - first - second).alias("probs"),
    )


def _rounded(df):
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.withColumns({c: r6(F.col(c)) for c in doubles})


@query(
    "regression_metrics",
    f"""WITH {JUDGED} SELECT lang, count(*) AS n, round(avg(abs(y_pred - y_true)), 6) AS mae,
          round(avg(pow(y_pred - y_true, 2)), 6) AS mse, round(sqrt(avg(pow(y_pred - y_true, 2))), 6) AS rmse,
          round(min(y_pred), 6) AS pred_min, round(max(y_pred), 6) AS pred_max,
          round(min(y_true), 6) AS true_min, round(max(y_true), 6) AS true_max FROM guessed GROUP BY lang""",
)
def _(spark, sf_dir):
    return _rounded(regression_metrics(_judged(spark, sf_dir), "y_true", "y_pred", ["lang"]))


@query(
    "binary_metrics",
    f"""WITH {JUDGED}, c AS (
          SELECT lang, count(*) AS n, count(*) FILTER (truth = 1 AND guess = 1) AS tp,
                 count(*) FILTER (truth = 0 AND guess = 1) AS fp, count(*) FILTER (truth = 0 AND guess = 0) AS tn,
                 count(*) FILTER (truth = 1 AND guess = 0) AS fn,
                 round(avg(-CASE WHEN truth = 1 THEN ln(p) ELSE ln(1 - p) END), 6) AS log_loss
          FROM guessed GROUP BY lang)
        SELECT *, round((tp + tn) / n, 6) AS accuracy,
               round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
               round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
               round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM c""",
)
def _(spark, sf_dir):
    return _rounded(binary_metrics(_judged(spark, sf_dir), "truth", "p", ["lang"]))


@query(
    "multiclass_metrics",
    f"""WITH {JUDGED} SELECT lang, count(*) AS n, count(*) FILTER (gcls = cls) AS correct,
          round(avg((gcls = cls)::INT), 6) AS accuracy, round(avg(-ln(pcls)), 6) AS log_loss
        FROM guessed GROUP BY lang""",
)
def _(spark, sf_dir):
    return _rounded(multiclass_metrics(_judged(spark, sf_dir), "cls", "probs", ["lang"]))


@query(
    "confusion_matrix",
    f"WITH {JUDGED} SELECT truth AS y_true, guess AS y_pred, count(*) AS n FROM guessed GROUP BY 1, 2",
)
def _(spark, sf_dir):
    judged = _judged(spark, sf_dir).select("truth", predicted_binary(F.col("p")).alias("guess"))
    return confusion_matrix(judged, "truth", "guess")


@query(
    "classification_report",
    f"""WITH {JUDGED}, k AS (SELECT DISTINCT unnest([cls, gcls]) AS label FROM guessed),
        c AS (SELECT label::VARCHAR AS label, count(*) FILTER (cls = label) AS support,
                     count(*) FILTER (gcls = label) AS guessed, count(*) FILTER (cls = label AND gcls = label) AS hits
              FROM guessed, k GROUP BY 1),
        s AS (SELECT label, coalesce(hits / nullif(guessed, 0), 0) AS precision,
                     coalesce(hits / nullif(support, 0), 0) AS recall,
                     coalesce(2 * hits / nullif(guessed + support, 0), 0) AS f1, support, hits FROM c)
        SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM s
        UNION ALL SELECT 'accuracy', round(sum(hits) / sum(support), 6), round(sum(hits) / sum(support), 6),
                         round(sum(hits) / sum(support), 6), sum(support)::BIGINT FROM s
        UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
                         sum(support)::BIGINT FROM s
        UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
                         round(sum(recall * support) / sum(support), 6),
                         round(sum(f1 * support) / sum(support), 6), sum(support)::BIGINT FROM s""",
)
def _(spark, sf_dir):
    judged = _judged(spark, sf_dir).select("cls", predicted_class(F.col("probs")).alias("guess"))
    return _rounded(classification_report(judged, "cls", "guess"))


@query(
    "task_summary",
    f"""WITH {JUDGED} SELECT 'length' AS task, 'regression' AS type, round(avg(pow(y_pred - y_true, 2)), 6) AS loss,
          round(avg(abs(y_pred - y_true)), 6) AS metric FROM guessed
        UNION ALL SELECT 'quality', 'binary_classification',
          round(avg(-CASE WHEN truth = 1 THEN ln(p) ELSE ln(1 - p) END), 6), round(avg((truth = guess)::INT), 6) FROM guessed
        UNION ALL SELECT 'class', 'classification', round(avg(-ln(pcls)), 6), round(avg((gcls = cls)::INT), 6) FROM guessed""",
)
def _(spark, sf_dir):
    judged = _judged(spark, sf_dir)
    return _rounded(
        task_summary(
            judged.select(F.lit("length").alias("task"), "y_true", "y_pred"),
            judged.select(F.lit("quality").alias("task"), F.col("truth").alias("y_true"), F.col("p").alias("probs")),
            judged.select(F.lit("class").alias("task"), F.col("cls").alias("y_true"), "probs"),
        )
    )
