"""SQL for the classification report, written from its definition."""

from __future__ import annotations


def report_sql(scored: str, classes: str, suffix: str = "", digits: int = 6) -> str:
    """Tail of a WITH query over ``scored(label, prediction)`` and ``classes(c)``."""
    return f"""per_class AS (
  SELECT c, count(*) FILTER (label = c AND prediction = c)::DOUBLE AS tp,
         count(*) FILTER (label = c) AS support, count(*) FILTER (prediction = c) AS predicted
  FROM {classes} k, {scored} GROUP BY c),
prf AS (
  SELECT *, coalesce(tp / nullif(predicted, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall,
         coalesce(2 * tp / nullif(support + predicted, 0), 0) AS f1 FROM per_class),
rows_ AS (
  SELECT 'class' AS row_kind, concat(c, '{suffix}') AS name, precision, recall, f1, support FROM prf
  UNION ALL SELECT 'summary', 'accuracy', NULL, NULL, sum(tp) / sum(support), sum(support) FROM prf
  UNION ALL SELECT 'summary', 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM prf
  UNION ALL SELECT 'summary', 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(f1 * support) / sum(support), sum(support) FROM prf)
SELECT row_kind, name, round(precision, {digits}) AS precision, round(recall, {digits}) AS recall, round(f1, {digits}) AS f1,
       support::BIGINT AS support FROM rows_"""
