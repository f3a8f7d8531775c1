"""SQL of the training-data queries that SQL can express."""

#: Distinct cases per strata key and category.
SUPPLY = """
WITH plain AS (
  SELECT DISTINCT c.case_id, k.strata_key,
    lower(trim(regexp_replace(c.strata[k.strata_key], '[‐-―−]', '-', 'g'))) AS said,
    CASE WHEN k.strata_key = 'pair_type' THEN lower(trim(regexp_replace(regexp_extract(c.rationale, '^([^/(]*)', 1), '[‐-―−]', '-', 'g'))) END AS told
  FROM labeled_cases c, (SELECT DISTINCT strata_key FROM sample_targets) k WHERE c.case_id IS NOT NULL),
picked AS (SELECT case_id, strata_key, CASE WHEN said IS NULL OR said IN ('','unknown','n/a','na','none','null') THEN told ELSE said END AS p FROM plain),
named AS (SELECT case_id, strata_key, CASE WHEN p IN ('','unknown','n/a','na','none','null') THEN NULL WHEN regexp_matches(p, '^[0-9]') THEN regexp_replace(p, '\\s+', '', 'g') ELSE regexp_replace(p, '[\\s_\\-]+', '_', 'g') END AS category FROM picked),
supply AS (SELECT strata_key, category, count(DISTINCT case_id) AS n FROM named GROUP BY 1, 2)"""

ORACLES = {
    "p1_found": SUPPLY
    + """
SELECT DISTINCT t.request_id, t.category FROM sample_targets t LEFT JOIN supply s ON s.strata_key = t.strata_key AND s.category = t.category
WHERE coalesce(s.n, 0) < greatest(t.min_rows, t.target_share * t.sample_rows)""",
    "p1_sizes": """
WITH n AS (SELECT count(DISTINCT case_id) AS n FROM labeled_cases WHERE case_id IS NOT NULL)
SELECT request_id, least(max(sample_rows), max(n)) AS n_rows, least(max(sample_rows), max(n)) AS n_cases FROM sample_targets, n GROUP BY request_id""",
    "p1_minimums": SUPPLY
    + """
SELECT t.request_id, t.strata_key, t.category, least(t.min_rows, coalesce(s.n, 0)) AS n_of_minimum
FROM sample_targets t LEFT JOIN supply s ON s.strata_key = t.strata_key AND s.category = t.category""",
}
