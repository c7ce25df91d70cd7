"""SQL fragments shared by the metric oracles."""

# Over tn, fp, fn, tp.
RATES_SQL = {
    "accuracy": "CAST(tp + tn AS DOUBLE) / (tn + fp + fn + tp)",
    "precision": "CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END",
    "recall": "CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END",
    "f1": "CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END",
}


def confusion_sql(source: str, pred: str = "pred", by: str = "", extra: str = "") -> str:
    """A SELECT of tn, fp, fn, tp (and the grouping columns)."""
    head = f"{by}, " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    counts = ", ".join(f"count(*) FILTER (WHERE label = {y} AND {pred} = {p}) AS {n}"
                       for n, y, p in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1)))
    return f"SELECT {head}{counts}{extra} FROM {source}{tail}"


def rank_ctes(source: str, by: str = "") -> str:
    """CTEs ending in `rank`: auc_roc and auc_pr per group of `by`."""
    head = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    return f"""
hist AS (SELECT {head}score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
         FROM {source} GROUP BY {head}score),
run AS (SELECT *, sum(neg) OVER ({part}ORDER BY score) - neg AS neg_below,
        sum(pos) OVER ({part}ORDER BY score DESC) AS tp_cum,
        sum(pos + neg) OVER ({part}ORDER BY score DESC) AS all_cum,
        sum(pos) OVER ({part.strip()}) AS p, sum(neg) OVER ({part.strip()}) AS q FROM hist),
rank AS (SELECT {head}CASE WHEN max(p) > 0 AND max(q) > 0 THEN
         CAST(sum(pos * (2 * neg_below + neg)) AS DOUBLE) / (2.0 * max(p) * max(q)) END AS auc_roc,
         sum(CASE WHEN p > 0 THEN CAST(pos AS DOUBLE) / p ELSE 0 END * CAST(tp_cum AS DOUBLE) / all_cum) AS auc_pr
         FROM run{tail})"""
