"""SQL for the drift statistics, on any two sources with the same columns."""

from __future__ import annotations

from collections.abc import Sequence


def drift_ctes(numeric: Sequence[str], text: Sequence[str], ref: str = "ref", cur: str = "cur") -> str:
    """CTEs ending in `dr`: test, value, score and drift flag of every column.

    p-values are replaced by the critical values of their tests at 0.05.
    """
    parts = []
    for side, a, b in ((ref, 1, 0), (cur, 0, 1)):
        for c in numeric:
            parts.append(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS num, CAST(NULL AS VARCHAR) AS cat, "
                         f"{a} AS r, {b} AS c FROM {side} WHERE {c} IS NOT NULL")
        for c in text:
            parts.append(f"SELECT '{c}', NULL, CAST({c} AS VARCHAR), {a}, {b} FROM {side} WHERE {c} IS NOT NULL")
    return f"""
vc AS (SELECT feature, num, cat, CAST(sum(r) AS BIGINT) AS r, CAST(sum(c) AS BIGINT) AS c
       FROM ({' UNION ALL '.join(parts)}) GROUP BY feature, num, cat),
pr AS (SELECT feature, CAST(sum(r) AS BIGINT) AS n_ref, CAST(sum(c) AS BIGINT) AS n_cur, count(*) AS n_values,
       min(num) AS first_num, min(cat) AS first_cat, sum(num * r) / sum(r) AS mean_ref FROM vc GROUP BY feature),
cum AS (SELECT vc.*, n_ref, n_cur, mean_ref,
        abs(CAST(sum(r) OVER w AS DOUBLE) / n_ref - CAST(sum(c) OVER w AS DOUBLE) / n_cur) AS gap,
        lead(num) OVER w - num AS step FROM vc JOIN pr ON pr.feature = vc.feature WHERE num IS NOT NULL
        WINDOW w AS (PARTITION BY vc.feature ORDER BY num)),
os AS (SELECT feature, max(gap) AS ks, coalesce(sum(gap * step), 0)
       / greatest(sqrt(sum(r * (num - mean_ref) * (num - mean_ref)) / max(n_ref)), 0.001) AS wasserstein
       FROM cum GROUP BY feature),
sh AS (SELECT vc.feature, n_ref, n_cur, CAST(r AS DOUBLE) / n_ref AS p, CAST(c AS DOUBLE) / n_cur AS q,
       CAST(r AS DOUBLE) * n_cur / n_ref AS scaled, c, r,
       coalesce(num = first_num, cat = first_cat) AS is_first FROM vc JOIN pr ON pr.feature = vc.feature),
ds AS (SELECT feature, sum(CASE WHEN c > 0 THEN (scaled - c) * (scaled - c) / c
                                ELSE CAST('Infinity' AS DOUBLE) END) AS chi_square,
       sqrt(greatest(sum((CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END
         + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2), 0)) AS jensen_shannon,
       1 - CAST(sum(CASE WHEN is_first THEN r ELSE 0 END) AS DOUBLE) / max(n_ref) AS p1,
       1 - CAST(sum(CASE WHEN is_first THEN c ELSE 0 END) AS DOUBLE) / max(n_cur) AS p2,
       1 - CAST(sum(CASE WHEN is_first THEN r + c ELSE 0 END) AS DOUBLE) / max(n_ref + n_cur) AS pooled,
       max(n_ref) AS n1, max(n_cur) AS n2 FROM sh GROUP BY feature),
zs AS (SELECT *, CASE WHEN pooled * (1 - pooled) > 0 THEN (p1 - p2)
       / sqrt(pooled * (1 - pooled) * (1.0 / n1 + 1.0 / n2)) ELSE 0 END AS z FROM ds),
ch AS (SELECT pr.*, CASE WHEN n_ref > 1000 THEN CASE WHEN first_cat IS NOT NULL OR n_values <= 5
         THEN 'Jensen-Shannon distance' ELSE 'Wasserstein distance (normed)' END
       WHEN first_cat IS NULL AND n_values > 5 THEN 'K-S p_value'
       WHEN n_values > 2 THEN 'chi-square p_value' ELSE 'Z-test p_value' END AS statistic FROM pr),
va AS (SELECT ch.*, CASE statistic WHEN 'Jensen-Shannon distance' THEN jensen_shannon
       WHEN 'Wasserstein distance (normed)' THEN wasserstein WHEN 'K-S p_value' THEN ks
       WHEN 'chi-square p_value' THEN chi_square ELSE z END AS value
       FROM ch LEFT JOIN os ON os.feature = ch.feature LEFT JOIN zs ON zs.feature = ch.feature),
dr AS (SELECT *, CASE statistic WHEN 'Jensen-Shannon distance' THEN value >= 0.1
       WHEN 'Wasserstein distance (normed)' THEN value >= 0.1
       WHEN 'K-S p_value' THEN value * sqrt(CAST(n_ref AS DOUBLE) * n_cur / (n_ref + n_cur)) > 1.3580986393225505
       WHEN 'Z-test p_value' THEN abs(value) > 1.959963984540054
       ELSE value > CASE n_values WHEN 3 THEN 5.991464547107979 WHEN 4 THEN 7.814727903251179
         WHEN 5 THEN 9.487729036781154 WHEN 6 THEN 11.070497693516351 WHEN 7 THEN 12.591587243743977
         WHEN 8 THEN 14.067140449340169 END END AS drifted FROM va)"""
