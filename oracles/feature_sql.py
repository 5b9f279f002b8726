"""Provider features, split, metrics, marts, measures and narratives in SQL."""

from __future__ import annotations

from adjudica.operators.features import FEATURES
from adjudica.schema import CHRONIC_FLAGS
from oracles.star_sql import CENTS, DEDUCT_CENTS, MONTH, half_up, money, with_star

_SHARES = {
    "renal_disease_ratio": "renal_disease", "alzheimer_ratio": "chronic_alzheimer",
    "heartfailure_ratio": "chronic_heartfailure", "kidneydisease_ratio": "chronic_kidneydisease",
    "diabetes_ratio": "chronic_diabetes", "ischemic_heart_ratio": "chronic_ischemicheart",
}
_BURDEN = " + ".join(f"coalesce({flag}::INT, 0)" for flag in CHRONIC_FLAGS)
_PAID = "CAST(sum(reimbursed_amount) AS DOUBLE)"
_DED = "CAST(sum(deductible_amount) AS DOUBLE)"

_RAW_FEATURES = f"""
SELECT p.provider_id, p.potential_fraud, total_claims, inpatient_claims, outpatient_claims, total_reimbursed,
  mean_reimbursed, std_reimbursed, max_reimbursed, median_reimbursed, total_deductible, mean_deductible,
  zero_reimbursed_count, inpatient_claims / total_claims AS inpatient_ratio,
  total_deductible / (total_reimbursed + 1.0::DOUBLE) AS deductible_to_reimbursement_ratio,
  zero_reimbursed_count / total_claims AS zero_reimbursed_ratio,
  coalesce(mean_length_of_stay, 0) AS mean_length_of_stay, coalesce(max_length_of_stay, 0) AS max_length_of_stay,
  coalesce(distinct_procedures, 0) AS distinct_procedures, distinct_attending_physicians,
  distinct_operating_physicians, distinct_diagnosis_codes, distinct_beneficiaries, mean_patient_age,
  renal_disease_ratio, mean_chronic_conditions, alzheimer_ratio, heartfailure_ratio, kidneydisease_ratio,
  diabetes_ratio, ischemic_heart_ratio, coalesce(same_day_duplicate_claims, 0) AS same_day_duplicate_claims,
  total_claims / (distinct_beneficiaries + 1e-5::DOUBLE) AS claims_per_beneficiary,
  distinct_attending_physicians / (total_claims + 1e-5::DOUBLE) AS physician_to_claim_ratio,
  total_reimbursed / (distinct_beneficiaries + 1e-5::DOUBLE) AS reimbursement_per_beneficiary
FROM dim_providers p LEFT JOIN (
  SELECT provider_id, count(claim_id) AS total_claims, count(*) FILTER (claim_type = 'Inpatient') AS inpatient_claims,
    count(*) FILTER (claim_type = 'Outpatient') AS outpatient_claims, {_PAID} AS total_reimbursed,
    {_PAID} / count(reimbursed_amount) AS mean_reimbursed,
    coalesce(stddev_samp(CAST(reimbursed_amount AS DOUBLE)), 0) AS std_reimbursed,
    CAST(max(reimbursed_amount) AS DOUBLE) AS max_reimbursed,
    median(CAST(reimbursed_amount AS DOUBLE)) AS median_reimbursed, {_DED} AS total_deductible,
    {_DED} / count(deductible_amount) AS mean_deductible,
    count(*) FILTER (reimbursed_amount = 0) AS zero_reimbursed_count,
    count(DISTINCT attending_physician) AS distinct_attending_physicians,
    count(DISTINCT operating_physician) AS distinct_operating_physicians,
    count(DISTINCT primary_diagnosis_code) AS distinct_diagnosis_codes
  FROM fact_claims_unified GROUP BY provider_id) v ON p.provider_id = v.provider_id
LEFT JOIN (
  SELECT provider_id, avg(length_of_stay) AS mean_length_of_stay, max(length_of_stay) AS max_length_of_stay,
    count(DISTINCT primary_procedure_code) AS distinct_procedures
  FROM fact_inpatient_claims GROUP BY provider_id) i ON p.provider_id = i.provider_id
LEFT JOIN (
  SELECT provider_id, count(DISTINCT c.bene_id) AS distinct_beneficiaries,
    avg(least(greatest(2009 - year(dob), 0), 115)) FILTER (dob IS NOT NULL) AS mean_patient_age,
    avg({_BURDEN}) AS mean_chronic_conditions,
    {', '.join(f'avg({flag}::INT) AS {name}' for name, flag in _SHARES.items())}
  FROM (SELECT DISTINCT provider_id, bene_id FROM fact_claims_unified) c
  LEFT JOIN dim_beneficiaries b ON c.bene_id = b.bene_id GROUP BY provider_id) m ON p.provider_id = m.provider_id
LEFT JOIN (
  SELECT provider_id, sum(n) AS same_day_duplicate_claims FROM (
    SELECT provider_id, bene_id, claim_start_date, count(*) AS n FROM fact_claims_unified
    WHERE bene_id IS NOT NULL AND claim_start_date IS NOT NULL GROUP BY ALL HAVING count(*) > 1) t
  GROUP BY provider_id) d ON p.provider_id = d.provider_id
"""
_ROUNDED = ", ".join(f"round(CAST({name} AS DOUBLE), 6) AS {name}" for name in FEATURES)
_EXACT = ", ".join(f"CAST({name} AS DOUBLE) AS {name}" for name in FEATURES)

_HEX = "CAST(CAST('0x' || substr(md5({}), 1, 4) AS INTEGER) AS BIGINT)"


def _size(label: str) -> str:
    return f"(SELECT count(*) FROM dim_providers WHERE potential_fraud = {label})"


EXTRA = {
    "exact_features": f"SELECT provider_id, potential_fraud, {_EXACT} FROM ({_RAW_FEATURES}) f",
    "provider_features": f"SELECT provider_id, potential_fraud, {_ROUNDED} FROM exact_features",
    "given_scores": f"""SELECT provider_id, potential_fraud,
  {_HEX.format("'score|' || provider_id")} % 1000 / 1000.0::DOUBLE AS probability FROM dim_providers""",
    "scored": "SELECT probability AS score, potential_fraud::INT AS label FROM given_scores",
    "ranked_providers": """SELECT provider_id, potential_fraud, row_number() OVER (PARTITION BY potential_fraud
  ORDER BY md5('42|' || provider_id), provider_id) AS r, count(*) OVER (PARTITION BY potential_fraud) AS n FROM dim_providers""",
    "split_providers": """SELECT provider_id, potential_fraud, CASE WHEN potential_fraud IS NOT NULL
  AND r <= greatest(1, CAST(floor(n * 0.2::DOUBLE) AS BIGINT)) THEN 'test' ELSE 'train' END AS split FROM ranked_providers""",
    "score_groups": "SELECT score, count(*) FILTER (label = 1) AS tp, count(*) FILTER (label = 0) AS fp FROM scored GROUP BY score",
    "score_cumulated": """SELECT *, CAST(sum(tp) OVER w AS BIGINT) AS ctp, CAST(sum(fp) OVER w AS BIGINT) AS cfp, CAST(sum(tp) OVER () AS DOUBLE) AS p,
  CAST(sum(fp) OVER () AS DOUBLE) AS n FROM score_groups WINDOW w AS (ORDER BY score DESC)""",
    "pr_points": """SELECT score AS threshold, ctp / (ctp + cfp) AS precision, ctp / p AS recall,
  2 * (ctp / (ctp + cfp)) * (ctp / p) / greatest(ctp / (ctp + cfp) + ctp / p, 1e-9::DOUBLE) AS f1 FROM score_cumulated""",
    "best_cut": "SELECT * FROM pr_points ORDER BY f1 DESC, threshold LIMIT 1",
    "risk_scores": """SELECT f.*, round_even(probability, 4) AS fraud_risk_probability,
  CAST(probability >= 0.5 AS BIGINT) AS model_fraud_prediction,
  CASE WHEN probability >= 0.5 THEN 'High Risk' WHEN probability >= 0.3 THEN 'Medium Risk' ELSE 'Low Risk' END AS risk_tier
  FROM exact_features f JOIN given_scores s ON f.provider_id = s.provider_id""",
    "drill": """SELECT claim_id, claim_type, provider_id,
  (SELECT fraud_label FROM dim_providers d WHERE d.provider_id = top.provider_id) AS ground_truth_fraud, bene_id,
  (SELECT CAST(state_id AS BIGINT) FROM dim_beneficiaries d WHERE d.bene_id = top.bene_id) AS state_id,
  (SELECT CAST(gender AS BIGINT) FROM dim_beneficiaries d WHERE d.bene_id = top.bene_id) AS gender,
  claim_start_date, claim_end_date, reimbursed_amount, deductible_amount, CAST(length_of_stay AS BIGINT) AS length_of_stay,
  attending_physician, primary_diagnosis_code
  FROM (FROM fact_claims_unified ORDER BY reimbursed_amount DESC, claim_id, claim_type LIMIT 15000) top""",
    "portfolio": """SELECT c.*, p.fraud_label AS ground_truth_fraud FROM fact_claims_unified c
  JOIN dim_providers p ON c.provider_id = p.provider_id""",
    "trends": f"""SELECT {MONTH} AS claim_year_month, CAST(count(*) AS BIGINT) AS total_claims,
  CAST(count(*) FILTER (claim_type = 'Inpatient') AS BIGINT) AS inpatient_claims,
  CAST(count(*) FILTER (claim_type = 'Outpatient') AS BIGINT) AS outpatient_claims,
  {money(CENTS)} AS total_reimbursement, {money(half_up(CENTS, 'count(*)'))} AS avg_reimbursement,
  count(DISTINCT provider_id) AS active_providers, count(DISTINCT bene_id) AS distinct_beneficiaries
  FROM fact_claims_unified GROUP BY 1""",
    "numbered_trends": """SELECT *, CAST(substr(claim_year_month, 1, 4) AS INT) * 12
  + CAST(substr(claim_year_month, 6, 2) AS INT) AS m FROM trends""",
    "given_phi": f"""SELECT provider_id, feature, value,
  ({_HEX.format("'phi|' || provider_id || '|' || feature")} % 2001 - 1000) / 1000.0::DOUBLE AS phi
  FROM (UNPIVOT provider_features ON {', '.join(FEATURES)} INTO NAME feature VALUE value) u""",
    "importance": "SELECT feature, round(avg(abs(phi)), 6) AS mean_abs_shap, avg(abs(phi)) AS exact FROM given_phi GROUP BY feature",
    "leaders": "SELECT feature, mean_abs_shap FROM importance ORDER BY exact DESC, feature LIMIT 15",
}

# A stand-in forest: scores by walking its nodes, attributions by all subsets of a tree's features.
EXTRA |= {
    "standin_nodes": """SELECT * FROM (VALUES
  (0, 0, 1, 2, 'total_claims', 510.5, 0.0, 100.0), (0, 1, 3, 4, 'inpatient_ratio', 0.3551, 0.0, 50.0),
  (0, 2, 5, 6, 'mean_length_of_stay', 2.4613, 0.0, 50.0), (0, 3, -1, -1, NULL, NULL, -0.4137, 20.0), (0, 4, -1, -1, NULL, NULL, 0.1093, 30.0),
  (0, 5, -1, -1, NULL, NULL, 0.2171, 25.0), (0, 6, 13, 14, 'total_reimbursed', 2100000.5, 0.0, 25.0),
  (0, 13, -1, -1, NULL, NULL, 0.5273, 10.0), (0, 14, -1, -1, NULL, NULL, 0.9119, 15.0),
  (1, 0, 1, 2, 'total_reimbursed', 2000000.5, 0.0, 100.0), (1, 1, -1, -1, NULL, NULL, -0.3231, 45.0),
  (1, 2, 5, 6, 'total_claims', 540.5, 0.0, 55.0), (1, 5, -1, -1, NULL, NULL, 0.2611, 35.0), (1, 6, -1, -1, NULL, NULL, -0.1523, 20.0),
  (2, 0, 1, 2, 'mean_patient_age', 66.1, 0.0, 100.0), (2, 1, 3, 4, 'total_claims', 480.5, 0.0, 50.0),
  (2, 2, 5, 6, 'renal_disease_ratio', 0.1439, 0.0, 50.0), (2, 3, -1, -1, NULL, NULL, -0.2047, 10.0), (2, 4, -1, -1, NULL, NULL, 0.0589, 40.0),
  (2, 5, -1, -1, NULL, NULL, 0.3163, 22.0), (2, 6, -1, -1, NULL, NULL, -0.3607, 28.0)
  ) t(tree, id, left_child, right_child, feature, cut, value, cover)""",
    "feature_values": f"SELECT provider_id, feature, value FROM (UNPIVOT exact_features ON {', '.join(FEATURES)} INTO NAME feature VALUE value) u",
    "forest_odds": """WITH RECURSIVE walk AS (
    SELECT provider_id, tree, id FROM exact_features CROSS JOIN standin_nodes WHERE id = 0
    UNION ALL SELECT w.provider_id, w.tree, CASE WHEN v.value <= n.cut::DOUBLE THEN n.left_child ELSE n.right_child END
    FROM walk w JOIN standin_nodes n ON n.tree = w.tree AND n.id = w.id
    JOIN feature_values v ON v.provider_id = w.provider_id AND v.feature = n.feature
  ) SELECT provider_id, sum(n.value::DOUBLE) AS log_odds FROM walk w JOIN standin_nodes n ON n.tree = w.tree AND n.id = w.id
  WHERE n.left_child < 0 GROUP BY provider_id""",
    "standin_scores": """SELECT f.provider_id, potential_fraud, 1 / (1 + exp(-log_odds)) AS probability
  FROM exact_features f JOIN forest_odds o ON o.provider_id = f.provider_id""",
    "tree_edges": """SELECT c.tree, c.id AS child, p.id AS parent, p.feature, p.cut::DOUBLE AS cut, p.left_child = c.id AS goes_left,
  c.cover::DOUBLE / p.cover::DOUBLE AS share FROM standin_nodes c JOIN standin_nodes p ON p.tree = c.tree AND c.id IN (p.left_child, p.right_child)""",
    "leaf_conditions": """WITH RECURSIVE up AS (
    SELECT tree, id AS leaf, id AS here FROM standin_nodes WHERE left_child < 0
    UNION ALL SELECT u.tree, leaf, e.parent FROM up u JOIN tree_edges e ON e.tree = u.tree AND e.child = u.here
  ) SELECT u.tree, leaf, e.feature, e.cut, e.goes_left, e.share FROM up u JOIN tree_edges e ON e.tree = u.tree AND e.child = u.here""",
    "tree_players": """SELECT tree, feature, row_number() OVER (PARTITION BY tree ORDER BY feature) - 1 AS bit, count(*) OVER (PARTITION BY tree) AS players
  FROM (SELECT DISTINCT tree, feature FROM standin_nodes WHERE feature IS NOT NULL) d""",
    "subset_worth": """SELECT provider_id, tree, mask, sum(reached * value) AS worth FROM (
    SELECT v.provider_id, c.tree, c.leaf, m.mask, any_value(n.value::DOUBLE) AS value,
      product(CASE WHEN (m.mask >> p.bit) & 1 = 1 THEN CAST((v.value <= c.cut) = c.goes_left AS DOUBLE) ELSE c.share END) AS reached
    FROM leaf_conditions c JOIN tree_players p ON p.tree = c.tree AND p.feature = c.feature
    JOIN (SELECT unnest(range(16)) AS mask) m ON m.mask < (1 << p.players)
    JOIN standin_nodes n ON n.tree = c.tree AND n.id = c.leaf JOIN feature_values v ON v.feature = c.feature
    GROUP BY ALL) l GROUP BY provider_id, tree, mask""",
    "exact_phi": """SELECT a.provider_id, p.feature, sum((b.worth - a.worth) * factorial(bit_count(a.mask)::INT)::DOUBLE
    * factorial((p.players - bit_count(a.mask) - 1)::INT)::DOUBLE / factorial(p.players::INT)::DOUBLE) AS phi
  FROM subset_worth a JOIN tree_players p ON p.tree = a.tree AND (a.mask >> p.bit) & 1 = 0
  JOIN subset_worth b ON b.provider_id = a.provider_id AND b.tree = a.tree AND b.mask = a.mask + (1 << p.bit) GROUP BY a.provider_id, p.feature""",
    "standin_phi": """SELECT v.provider_id, v.feature, v.value, coalesce(phi, 0) AS phi FROM feature_values v
  LEFT JOIN exact_phi e ON e.provider_id = v.provider_id AND e.feature = v.feature""",
    "standin_leaders": "SELECT feature, avg(abs(phi)) AS m FROM standin_phi GROUP BY feature ORDER BY m DESC, feature LIMIT 10",
}

_RATE = "coalesce(count(*) FILTER (ground_truth_fraud = 'Yes') / nullif(count(*), 0) * 100, 0)"
_RAG = f"CASE WHEN {_RATE} > 35 THEN 'RED' WHEN {_RATE} >= 20 THEN 'AMBER' ELSE 'GREEN' END"
_CLAIM_MEASURES = {
    "a01_total_claims": "CAST(count(*) AS BIGINT) AS total_claims",
    "a02_total_reimbursement": f"{money(CENTS)} AS total_reimbursement",
    "a03_avg_claim_cost": f"round({money(CENTS)} / count(reimbursed_amount), 6) AS avg_claim_cost",
    "a04_total_deductibles_paid": f"{money(DEDUCT_CENTS)} AS total_deductibles_paid",
    "a06_total_beneficiaries": "count(DISTINCT bene_id) AS total_beneficiaries",
    "a07_fraud_claims_count": "CAST(count(*) FILTER (ground_truth_fraud = 'Yes') AS BIGINT) AS fraud_claims_count",
    "a08_portfolio_fraud_rate": f"round({_RATE}, 6) AS portfolio_fraud_rate_pct",
    "a12_inpatient_cost_ratio": """round(coalesce(CAST(sum(reimbursed_amount) FILTER (claim_type = 'Inpatient') AS DOUBLE)
  / nullif(CAST(sum(reimbursed_amount) AS DOUBLE), 0), 0) * 100, 6) AS inpatient_cost_ratio_pct""",
    "a13_fraud_rate_rag": f"{_RAG} AS fraud_rate_rag_status",
    "a14_fraud_rate_colour": f"""CASE {_RAG} WHEN 'RED' THEN '#E74C3C' WHEN 'AMBER' THEN '#F39C12'
  WHEN 'GREEN' THEN '#2ECC71' ELSE '#BDC3C7' END AS fraud_rate_hex_color""",
}
_BADGE = """CASE WHEN count(DISTINCT risk_tier) > 1 THEN '#CCCCCC' ELSE CASE min(risk_tier) WHEN 'High Risk' THEN '#D9534F'
  WHEN 'Medium Risk' THEN '#F0AD4E' WHEN 'Low Risk' THEN '#5CB85C' ELSE '#CCCCCC' END END AS provider_risk_badge_color"""


def _summary(prefix: str, group: str) -> str:
    one = "count(DISTINCT {0}) = 1"
    return f"""SELECT {prefix} 'Provider ' || CASE WHEN {one.format('provider_id')} THEN min(provider_id) ELSE 'None Selected' END
  || ' | Model Probability: ' || printf('%.1f%%', CASE WHEN {one.format('fraud_risk_probability')}
     THEN min(fraud_risk_probability) ELSE 0 END * 100)
  || ' | Tier: ' || CASE WHEN {one.format('risk_tier')} THEN min(risk_tier) ELSE 'Unknown' END
  AS selected_provider_risk_summary FROM risk_scores {group}"""


def _cut(value: str) -> str:
    tp = "count(*) FILTER (label = 1 AND score >= t)"
    fp = "count(*) FILTER (label = 0 AND score >= t)"
    fn = "count(*) FILTER (label = 1 AND score < t)"
    tn = "count(*) FILTER (label = 0 AND score < t)"
    return f"""SELECT round(max(t), 6) AS threshold, round(coalesce({tp} / nullif({tp} + {fp}, 0), 0), 6) AS precision,
  round(coalesce({tp} / nullif({tp} + {fn}, 0), 0), 6) AS recall,
  round(coalesce(2 * {tp} / nullif(2 * {tp} + {fp} + {fn}, 0), 0), 6) AS f1_score,
  {tn} AS tn, {fp} AS fp, {fn} AS fn, {tp} AS tp FROM (SELECT *, {value} AS t FROM scored) s"""


_AUC = "sum(fp * (ctp - tp) + 0.5::DOUBLE * fp * tp) / (max(p) * max(n))"
_AP = "sum(tp / p * ctp / (ctp + cfp))"


def _report() -> str:
    parts = []
    for block, cut in (("default", "0.5::DOUBLE"), ("tuned", "0.7::DOUBLE")):
        parts += [f"(SELECT {name} FROM ({_cut(cut)}) c) AS {block}_{name}" for name in ("precision", "recall", "f1_score")]
    parts += [f"(SELECT {name} FROM ({_cut('0.7::DOUBLE')}) c) AS tuned_{name}" for name in ("tn", "tp")]
    return f"SELECT round({_AUC}, 6) AS roc_auc, round({_AP}, 6) AS pr_auc, {', '.join(parts)} FROM score_cumulated"


_DRILL_COLUMNS = """d.claim_id, d.claim_type, d.provider_id, d.ground_truth_fraud, d.bene_id, d.state_id, d.gender,
  CAST(d.claim_start_date AS VARCHAR) AS claim_start_date, CAST(d.claim_end_date AS VARCHAR) AS claim_end_date,
  CAST(d.reimbursed_amount AS DOUBLE) AS reimbursed_amount, CAST(d.deductible_amount AS DOUBLE) AS deductible_amount,
  d.length_of_stay, d.attending_physician, d.primary_diagnosis_code"""
_RISK_ROUNDED = f"""provider_id, potential_fraud, {_ROUNDED}, round(fraud_risk_probability, 6) AS fraud_risk_probability,
  model_fraud_prediction, risk_tier"""
_COMPARED = ["chronic_alzheimer", "chronic_heartfailure", "chronic_kidneydisease", "chronic_diabetes"]

_PLACED_PHI = "row_number() OVER (PARTITION BY provider_id, phi > 0 ORDER BY abs(phi) DESC, feature)"
_SENTENCE = """CASE WHEN phi > 0 THEN '+ High Risk Driver: ''' || feature || ''' (value: ' || printf('%.2f', round_even(value, 2))
    || ') increased log-odds by +' || printf('%.3f', phi)
  ELSE '- Mitigating Factor: ''' || feature || ''' (value: ' || printf('%.2f', round_even(value, 2))
    || ') reduced log-odds by ' || printf('%.3f', phi) END"""

_BODIES = {
    "f01_provider_features": "SELECT * FROM provider_features",
    "flagship_provider_profile": f"""SELECT f.*, payout_decile FROM provider_features f LEFT JOIN (
  SELECT provider_id, CAST(ntile(10) OVER (ORDER BY paid DESC, provider_id) AS BIGINT) AS payout_decile
  FROM (SELECT provider_id, {CENTS} AS paid FROM fact_claims_unified GROUP BY provider_id) t) d USING (provider_id)""",
    "p04_sample_rows": "SELECT provider_id FROM dim_providers ORDER BY md5('42|' || provider_id), provider_id LIMIT 1500",
    "p04_sample_rows_25": "SELECT provider_id FROM dim_providers ORDER BY md5('42|' || provider_id), provider_id LIMIT 25",
    "m01_group_split": "SELECT * FROM split_providers",
    "m02_split_summary": """SELECT split, count(*) AS providers, count(*) FILTER (potential_fraud) AS fraud,
  count(*) FILTER (NOT potential_fraud) AS clean, round(avg(potential_fraud::INT), 6) AS fraud_rate
  FROM split_providers GROUP BY split""",
    "m03_class_weight": """SELECT count(*) FILTER (NOT potential_fraud) AS negatives, count(*) FILTER (potential_fraud) AS positives,
  round(count(*) FILTER (NOT potential_fraud) / greatest(count(*) FILTER (potential_fraud), 1), 4) AS scale_pos_weight
  FROM split_providers WHERE split = 'train'""",
    "m04_majority_baseline": """SELECT round(CASE WHEN major THEN rate ELSE 0 END, 6) AS precision,
  CAST(CASE WHEN major THEN 1 ELSE 0 END AS DOUBLE) AS recall,
  round(CASE WHEN major THEN 2 * rate / (1 + rate) ELSE 0 END, 6) AS f1_score, 0.5::DOUBLE AS roc_auc, round(rate, 6) AS pr_auc
  FROM (SELECT (SELECT count(*) FILTER (potential_fraud) > count(*) FILTER (NOT potential_fraud)
    FROM split_providers WHERE split = 'train') AS major, avg(potential_fraud::INT) AS rate
    FROM split_providers WHERE split = 'test') t""",
    "m07_fold_assignment": """SELECT provider_id, CAST((row_number() OVER (PARTITION BY potential_fraud
  ORDER BY md5('42|' || provider_id), provider_id) - 1) % 5 AS BIGINT) AS fold FROM split_providers WHERE split = 'train'""",
    "m09_pr_curve": """SELECT round(threshold, 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(f1, 6) AS f1 FROM pr_points""",
    "m10_best_threshold": """SELECT round(threshold, 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(f1, 6) AS f1 FROM best_cut""",
    "m11_threshold_metrics": _cut("0.5::DOUBLE"),
    "m11_tuned_metrics": _cut("(SELECT threshold FROM best_cut)"),
    "m12_roc_auc": f"SELECT round({_AUC}, 6) AS roc_auc FROM score_cumulated",
    "m13_average_precision": f"SELECT round({_AP}, 6) AS pr_auc FROM score_cumulated",
    "m14_evaluation_report": _report(),
    "b01_provider_risk_scores": f"SELECT {_RISK_ROUNDED} FROM risk_scores",
    "b02_risk_tiers": "SELECT risk_tier, count(*) AS providers FROM risk_scores GROUP BY risk_tier",
    "b03_kpi_summary": f"""SELECT CAST(count(*) AS BIGINT) AS total_claims, count(DISTINCT bene_id) AS distinct_beneficiaries,
  count(DISTINCT c.provider_id) AS total_providers, {_size('true')} AS fraudulent_providers_count,
  CAST((2 * 10000 * {_size('true')} + (SELECT count(*) FROM dim_providers)) // (2 * (SELECT count(*) FROM dim_providers)) AS DOUBLE) / 100
    AS portfolio_fraud_provider_rate_pct,
  {money(CENTS)} AS total_reimbursement_usd,
  {money("CAST(sum(reimbursed_amount) FILTER (potential_fraud) * 100 AS BIGINT)")} AS total_fraud_loss_exposure_usd,
  CAST((2 * 10000 * CAST(sum(reimbursed_amount) FILTER (potential_fraud) * 100 AS BIGINT) + {CENTS}) // (2 * {CENTS}) AS DOUBLE) / 100
    AS fraud_financial_share_pct,
  {money(half_up(CENTS, 'count(*)'))} AS avg_reimbursement_per_claim_usd, {money(DEDUCT_CENTS)} AS total_deductible_usd
  FROM fact_claims_unified c JOIN dim_providers p ON c.provider_id = p.provider_id""",
    "b04_temporal_trends": "SELECT * FROM trends",
    "s06_write_mart": "SELECT * FROM trends",
    "b05_state_geographic_summary": f"""SELECT CAST(b.state_id AS BIGINT) AS state_id, CAST(count(*) AS BIGINT) AS total_claims,
  count(DISTINCT c.bene_id) AS total_patients, count(DISTINCT c.provider_id) AS total_providers,
  {money(CENTS)} AS total_reimbursement, {money(half_up(CENTS, 'count(*)'))} AS avg_reimbursement,
  CAST(count(*) FILTER (p.potential_fraud) AS BIGINT) AS fraud_claims_count,
  CAST({half_up('10000 * CAST(count(*) FILTER (p.potential_fraud) AS BIGINT)', 'count(*)')} AS DOUBLE) / 100 AS fraud_claim_rate_pct
  FROM fact_claims_unified c JOIN dim_beneficiaries b ON c.bene_id = b.bene_id
  JOIN dim_providers p ON c.provider_id = p.provider_id GROUP BY b.state_id""",
    "b06_claims_drillthrough": f"""SELECT {_DRILL_COLUMNS}, fraud_risk_probability, risk_tier
  FROM drill d LEFT JOIN risk_scores r ON d.provider_id = r.provider_id""",
    "b07_export_all": f"""SELECT 'provider_risk_scores' AS "table", count(*) AS rows FROM risk_scores
  UNION ALL SELECT 'kpi_summary', count(*) FROM (SELECT count(*) FROM fact_claims_unified) whole
  UNION ALL SELECT 'temporal_trends', count(DISTINCT {MONTH}) FROM fact_claims_unified
  UNION ALL SELECT 'state_geographic_summary', count(DISTINCT state_id) FROM fact_claims_unified JOIN dim_beneficiaries USING (bene_id)
  UNION ALL SELECT 'claims_drillthrough_analytical', least(15000, count(*)) FROM fact_claims_unified""",
    "a05_active_providers": "SELECT count(DISTINCT provider_id) AS active_providers FROM risk_scores",
    "a09_predicted_high_risk": "SELECT count(*) FILTER (risk_tier = 'High Risk') AS predicted_high_risk_providers FROM risk_scores",
    "a10_high_risk_provider_pct": """SELECT round(coalesce(count(*) FILTER (risk_tier = 'High Risk')
  / nullif(count(DISTINCT provider_id), 0), 0) * 100, 6) AS high_risk_provider_pct FROM risk_scores""",
    "a11_fraud_loss_exposure": f"""SELECT {money("CAST(sum(reimbursed_amount) FILTER (potential_fraud) * 100 AS BIGINT)")}
  AS total_fraud_loss_exposure FROM fact_claims_unified c JOIN dim_providers p ON c.provider_id = p.provider_id""",
    "a15_risk_badge_colour": f"SELECT {_BADGE} FROM risk_scores",
    "a15_risk_badge_colour_by_provider": f"SELECT provider_id, {_BADGE} FROM risk_scores GROUP BY provider_id",
    "a20_provider_summary": _summary("", ""),
    "a20_provider_summary_by_provider": _summary("provider_id AS selected,", "GROUP BY provider_id"),
    "a16_prior_month_claims": """SELECT claim_year_month, total_claims, CAST(sum(total_claims) OVER (ORDER BY m
  RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS BIGINT) AS prior_month_claims FROM numbered_trends""",
    "a17_month_growth": """SELECT t.claim_year_month, round(CASE WHEN b.m IS NOT NULL
  THEN coalesce((t.total_claims - b.total_claims) / nullif(b.total_claims, 0), 0) * 100 END, 6) AS mom_claim_volume_growth_pct
  FROM numbered_trends t LEFT JOIN numbered_trends b ON b.m = t.m - 1""",
    "a18_rolling_reimbursement": """SELECT claim_year_month, round(avg(total_reimbursement) OVER (ORDER BY m
  RANGE BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS rolling_3_month_avg_reimbursement FROM numbered_trends""",
    "a19_provider_rank": f"""SELECT provider_id, {money('paid')} AS total_reimbursement,
  dense_rank() OVER (ORDER BY paid DESC) AS provider_state_reimbursement_rank
  FROM (SELECT p.provider_id, coalesce(paid, 0) AS paid FROM dim_providers p LEFT JOIN (
    SELECT provider_id, {CENTS} AS paid FROM portfolio GROUP BY provider_id) d ON p.provider_id = d.provider_id) t""",
    "g01_claim_type_mix": f"""SELECT claim_type, claims, {money('paid')} AS total_reimbursement,
  CAST((2 * 10000 * claims + CAST(sum(claims) OVER () AS BIGINT)) // (2 * CAST(sum(claims) OVER () AS BIGINT)) AS DOUBLE) / 100 AS claim_share_pct,
  round(paid / CAST(sum(paid) OVER () AS DOUBLE) * 100, 6) AS money_share_pct
  FROM (SELECT claim_type, CAST(count(*) AS BIGINT) AS claims, {CENTS} AS paid FROM fact_claims_unified GROUP BY claim_type) t""",
    "g02_flagged_states": f"""SELECT CAST(state_id AS BIGINT) AS state_id, {money('exposed')} AS fraud_exposure, flagged_claims, total_claims FROM (
  SELECT b.state_id, coalesce(CAST(sum(reimbursed_amount) FILTER (potential_fraud) * 100 AS BIGINT), 0) AS exposed,
    CAST(count(*) FILTER (potential_fraud) AS BIGINT) AS flagged_claims, CAST(count(*) AS BIGINT) AS total_claims
  FROM fact_claims_unified c JOIN dim_beneficiaries b ON c.bene_id = b.bene_id
  JOIN dim_providers p ON c.provider_id = p.provider_id GROUP BY b.state_id) t ORDER BY exposed DESC, state_id LIMIT 10""",
    "g03_provider_quadrant": """SELECT provider_id, round(log10(total_claims), 6) AS log_claims,
  round(mean_reimbursed, 6) AS mean_reimbursed, round(total_reimbursed, 6) AS total_reimbursed, risk_tier,
  CASE WHEN total_claims > (SELECT median(total_claims) FROM risk_scores) THEN 'high volume' ELSE 'low volume' END || ', ' ||
  CASE WHEN mean_reimbursed > (SELECT median(mean_reimbursed) FROM risk_scores) THEN 'high payout' ELSE 'low payout' END AS quadrant
  FROM risk_scores""",
    "g04_risk_queue": """SELECT provider_id, risk_tier, round(fraud_risk_probability, 6) AS fraud_risk_probability,
  round(total_reimbursed, 6) AS total_reimbursed, round(claims_per_beneficiary, 6) AS claims_per_beneficiary,
  round(same_day_duplicate_claims, 6) AS same_day_duplicate_claims FROM risk_scores r
  ORDER BY r.fraud_risk_probability DESC, provider_id LIMIT 20""",
    "g05_filter_providers": """SELECT provider_id, risk_tier, CAST(total_claims AS BIGINT) AS total_claims FROM risk_scores
  WHERE total_claims >= 100 AND risk_tier IN ('High Risk', 'Medium Risk') AND provider_id IN (
    SELECT provider_id FROM fact_claims_unified WHERE bene_id IN (SELECT bene_id FROM dim_beneficiaries WHERE state_id IN (1, 5, 10)))""",
    "g06_condition_prevalence": f"""SELECT p.fraud_label, CAST(count(*) AS BIGINT) AS claims, {money(CENTS)} AS total_reimbursement,
  {', '.join(f'round(avg({name}::INT), 6) AS {name}_share' for name in _COMPARED)}
  FROM fact_claims_unified c JOIN dim_beneficiaries b ON c.bene_id = b.bene_id
  JOIN dim_providers p ON c.provider_id = p.provider_id GROUP BY p.fraud_label""",
    "g07_stay_histogram": """SELECT CAST(length_of_stay AS BIGINT) AS length_of_stay, CAST(count(*) AS BIGINT) AS claims,
  length_of_stay > 15 AS long_stay FROM fact_inpatient_claims GROUP BY fact_inpatient_claims.length_of_stay""",
    "g07_stay_quartiles": """SELECT CAST(min(length_of_stay) AS BIGINT) AS shortest,
  CAST(quantile_cont(length_of_stay, 0.25) AS DOUBLE) AS q1, CAST(quantile_cont(length_of_stay, 0.5) AS DOUBLE) AS q2,
  CAST(quantile_cont(length_of_stay, 0.75) AS DOUBLE) AS q3, CAST(max(length_of_stay) AS BIGINT) AS longest,
  CAST(count(*) FILTER (length_of_stay > 15) AS BIGINT) AS long_stays FROM fact_inpatient_claims""",
    "g08_same_day_distribution": """SELECT n AS claims_per_day, CAST(count(*) AS BIGINT) AS groups FROM (
  SELECT count(claim_id) AS n FROM fact_claims_unified GROUP BY provider_id, bene_id, claim_start_date) t GROUP BY n""",
    "g09_claim_audit": """SELECT claim_id, claim_type, CAST(claim_start_date AS VARCHAR) AS claim_start_date,
  CAST(reimbursed_amount AS DOUBLE) AS reimbursed_amount, CAST(deductible_amount AS DOUBLE) AS deductible_amount,
  CAST(length_of_stay AS BIGINT) AS length_of_stay, attending_physician, primary_diagnosis_code
  FROM fact_claims_unified WHERE provider_id = 'PRV3'""",
    "g10_physician_network": """SELECT provider_id, attending_physician, claims,
  round(claims / CAST(sum(claims) OVER (PARTITION BY provider_id) AS DOUBLE), 6) AS share_of_provider
  FROM (SELECT provider_id, attending_physician, CAST(count(*) AS BIGINT) AS claims FROM fact_claims_unified
  WHERE attending_physician IS NOT NULL GROUP BY ALL) t""",
    "x02_global_importance": "SELECT feature, mean_abs_shap FROM importance",
    "s07_write_json": "SELECT feature, mean_abs_shap FROM importance",
    "x03_top_features": "SELECT * FROM leaders",
    "x04_top_feature_values": "SELECT provider_id, feature, round(value, 6) AS value, round(phi, 6) AS phi FROM given_phi SEMI JOIN leaders USING (feature)",
    "x05_highest_risk": """SELECT provider_id, potential_fraud, round(probability, 6) AS probability FROM given_scores
  ORDER BY given_scores.probability DESC, provider_id LIMIT 1""",
    "x06_contribution_breakdown": """SELECT provider_id, CAST(position AS BIGINT) AS position,
  CASE WHEN position = 10 AND count(*) > 1 THEN count(*) || ' other features' ELSE min(feature) END AS feature,
  round(sum(phi), 6) + 0.0::DOUBLE AS phi FROM (SELECT *, least(row_number() OVER (PARTITION BY provider_id
    ORDER BY abs(phi) DESC, feature), 10) AS position FROM given_phi) t GROUP BY provider_id, t.position""",
    "x07_narratives": f"""SELECT s.provider_id, round_even(probability, 4) AS predicted_fraud_probability,
  CASE WHEN probability >= 0.5 THEN 'CRITICAL / HIGH' ELSE 'LOW / MONITORED' END AS assigned_risk_tier,
  CASE WHEN potential_fraud THEN 'Fraud' WHEN NOT potential_fraud THEN 'Non-Fraud' ELSE 'Unknown' END AS ground_truth_label,
  coalesce(told, '') AS decision_rationale FROM given_scores s LEFT JOIN (
    SELECT provider_id, string_agg({_SENTENCE}, chr(10) ORDER BY phi <= 0, place) AS told FROM (
      SELECT *, {_PLACED_PHI} AS place FROM given_phi WHERE phi <> 0) p
    WHERE place <= CASE WHEN phi > 0 THEN 4 ELSE 2 END GROUP BY provider_id) n ON s.provider_id = n.provider_id""",
}
_BODIES |= {
    "m08_scores": "SELECT provider_id, potential_fraud, round(probability, 6) AS probability FROM standin_scores",
    "s08_forest_round_trip": """SELECT tree::BIGINT AS tree, id::BIGINT AS id, left_child::BIGINT AS left_child, right_child::BIGINT AS right_child,
  feature, cut::DOUBLE AS cut, value::DOUBLE AS value, cover::DOUBLE AS cover FROM standin_nodes""",
    "x01_standin_attributions": "SELECT provider_id, feature, round(value, 6) AS value, round(phi, 6) + 0.0::DOUBLE AS phi FROM standin_phi",
    "x01_additivity": """SELECT o.provider_id, round(log_odds, 6) AS log_odds, round(log_odds - expected, 6) AS phi_sum FROM forest_odds o,
  (SELECT sum(part) AS expected FROM (SELECT any_value(n.value::DOUBLE) * product(share) AS part FROM leaf_conditions c
    JOIN standin_nodes n ON n.tree = c.tree AND n.id = c.leaf GROUP BY c.tree, c.leaf) l) e""",
    "x07_standin_narratives": _BODIES["x07_narratives"].replace("given_", "standin_"),
    "x08_standin_summary": f"""SELECT (SELECT string_agg(feature, ',' ORDER BY m DESC, feature DESC) FROM standin_leaders) AS top_features,
  provider_id, assigned_risk_tier, decision_rationale FROM ({_BODIES["x07_narratives"].replace("given_", "standin_")}) t
  WHERE provider_id = (SELECT provider_id FROM standin_scores ORDER BY probability DESC, provider_id LIMIT 1)""",
}
_BODIES |= {name: f"SELECT {value} FROM portfolio" for name, value in _CLAIM_MEASURES.items()}
_BODIES |= {
    f"{name}_by_type": f"SELECT claim_type, {value} FROM portfolio GROUP BY claim_type"
    for name, value in _CLAIM_MEASURES.items()
}

ORACLES = {name: with_star(body, EXTRA) for name, body in _BODIES.items()}
