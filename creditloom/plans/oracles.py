"""SQL oracles: the same results as ``queries``, written naively for a single-node SQL engine.

They sort and number whole tables where the Spark plans avoid that, so agreement checks the distributed forms.
Each entry of ``PARTS`` is a named subquery; ``_with`` adds those a text mentions, and their own, as CTEs.
"""

from __future__ import annotations

import re

from creditloom import fixed_values as fixed
from creditloom.sources import adapters

PARTS: dict[str, str] = {f"in_{name}": adapters.adapter_sql(name) for name in adapters.ADAPTERS}
ORACLES: dict[str, str] = {}


def _with(body: str) -> str:
    """Prefix ``body`` with the subqueries it needs, in dependency order."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in PARTS:
            if name not in order and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                need(PARTS[name])
                order.append(name)

    need(body)
    body = body.strip()
    return "WITH " + ",\n".join(f"{n} AS ({PARTS[n].strip()})" for n in order) + "\n" + body if order else body


def oracle(name: str, body: str) -> None:
    ORACLES[name] = body


def _in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _blank(column: str, tokens=fixed.NULL_TOKENS) -> str:
    return f"CASE WHEN {column} IN ({_in(tokens)}) THEN NULL ELSE {column} END"


def _number(column: str, keep: str, to: str) -> str:
    return f"TRY_CAST(regexp_replace({_blank(column)}, '[^{keep}]', '', 'g') AS {to})"


# --- ledger -----------------------------------------------------------------------------------------------------

_ARREARS = """
SELECT *, CAST(CASE WHEN overdue_amt > 0 THEN datediff('day', first_missed_date, snapshot_date) ELSE 0 END AS INT) AS dpd
FROM (SELECT *, CASE WHEN installments_missed > 0 THEN CAST(snapshot_date - to_months(installments_missed) AS DATE) END AS first_missed_date
      FROM ({missed}) a) b"""

PARTS["s_loans"] = _ARREARS.format(
    missed="""SELECT *, installment_num AS mob,
    CASE WHEN due_amt IS NULL OR due_amt = 0 THEN 0 ELSE CAST(ceil(overdue_amt / due_amt) AS INT) END AS installments_missed
    FROM in_loans WHERE Customer_ID IS NOT NULL AND snapshot_date IS NOT NULL"""
)
PARTS["f_loans"] = """SELECT loan_id, Customer_ID, loan_start_date, tenure, installment_num, CAST(loan_amt AS FLOAT) AS loan_amt,
    CAST(due_amt AS FLOAT) AS due_amt, CAST(paid_amt AS FLOAT) AS paid_amt, CAST(overdue_amt AS FLOAT) AS overdue_amt,
    coalesce(CAST(balance AS FLOAT), 0) AS balance, snapshot_date FROM in_loans"""
PARTS["s_loans_lab"] = _ARREARS.format(
    missed="""SELECT *, installment_num AS mob,
    coalesce(CAST(ceil(CAST(overdue_amt AS DOUBLE) / nullif(CAST(due_amt AS DOUBLE), 0)) AS INT), 0) AS installments_missed FROM f_loans"""
)
_BAD = "CASE WHEN dpd >= 30 THEN 1 ELSE 0 END"
_BAD_RATE = f"""SELECT mob, count(*) AS loans, CAST(sum({_BAD}) AS BIGINT) AS bads, round(avg({_BAD}), 6) AS bad_rate
FROM s_loans {{where}} GROUP BY mob"""
oracle("bad_rate_by_mob", _BAD_RATE.format(where=""))
oracle("bad_rate_completed_cohort", _BAD_RATE.format(where="WHERE loan_start_date < DATE '1998-01-01'"))
oracle(
    "fixed_instalment_bads",
    f"SELECT loan_id, Customer_ID, snapshot_date, dpd, {_BAD} AS dpd_flag FROM s_loans WHERE installment_num = 5",
)
oracle("silver_loans", "SELECT * FROM s_loans")
oracle(
    "silver_loans_lab_variant",
    """SELECT * REPLACE (round(CAST(loan_amt AS DOUBLE), 2) AS loan_amt, round(CAST(due_amt AS DOUBLE), 2) AS due_amt,
  round(CAST(paid_amt AS DOUBLE), 2) AS paid_amt, round(CAST(overdue_amt AS DOUBLE), 2) AS overdue_amt,
  round(CAST(balance AS DOUBLE), 2) AS balance) FROM s_loans_lab""",
)
for _mob in (3, 6):
    PARTS[f"labels_{_mob}"] = (
        f"SELECT Customer_ID, loan_id, {_BAD} AS label, snapshot_date, '30dpd_{_mob}mob' AS label_def FROM s_loans WHERE mob = {_mob}"
    )
    oracle(f"label_store_30dpd_{_mob}mob", f"SELECT * FROM labels_{_mob}")
oracle("label_distribution", "SELECT label, count(*) AS loans FROM labels_3 GROUP BY label")
oracle("snapshot_row_audit", "SELECT snapshot_date, count(*) AS rows FROM in_loans GROUP BY 1")
oracle("snapshot_dates", "SELECT DISTINCT snapshot_date FROM in_loans")
_SCAN = "SELECT loan_id, installment_num, snapshot_date FROM in_loans WHERE snapshot_date "
oracle("snapshot_scan_eq", _SCAN + "= DATE '1998-03-01'")
oracle("snapshot_scan_range", _SCAN + "BETWEEN DATE '1997-07-01' AND DATE '1998-06-30'")
oracle("snapshot_scan_upto", _SCAN + "<= DATE '1996-12-31'")

# --- cleaning ---------------------------------------------------------------------------------------------------

_TEXT_CELLS = ["Credit_History_Age", "Type_of_Loan", "Credit_Mix", "Payment_of_Min_Amount"]
_CLEAN = [
    f"{_number(c, keep, to.upper())} AS {c}"
    for c, (keep, to) in fixed.FINANCIAL_NUMBERS.items()
    if c != "Monthly_Inhand_Salary"
]
_TYPES = "[lower(trim(x)) FOR x IN regexp_split_to_array({c}, '{p}')]"
_STORED = _TYPES.format(c=_blank("Type_of_Loan"), p=fixed.LOAN_TYPE_SEPARATOR)
_CLEANED = _TYPES.format(c="Type_of_Loan", p=fixed.LOAN_TYPE_SEPARATOR_CLEAN)
PARTS["s_fin"] = f"""SELECT * REPLACE ({", ".join(_CLEAN)}, {", ".join(f"{_blank(c)} AS {c}" for c in _TEXT_CELLS)},
  CASE WHEN Payment_Behaviour IN ({_in(fixed.PAYMENT_BEHAVIOURS)}) THEN Payment_Behaviour END AS Payment_Behaviour),
  {_STORED} AS Loan_Types_Array
FROM in_financials WHERE Customer_ID IS NOT NULL AND snapshot_date IS NOT NULL"""
oracle(
    "silver_financials",
    "SELECT * REPLACE (array_to_string(Loan_Types_Array, '; ') AS Loan_Types_Array) FROM s_fin",
)
oracle(
    "loan_type_array",
    f"""SELECT row_id, array_to_string({_STORED}, '; ') AS loan_types, array_to_string({_CLEANED}, '; ') AS loan_types_clean,
  CAST(coalesce(len({_STORED}), -1) AS INT) AS num_loan_types FROM in_financials""",
)
_MONTHS = """TRY_CAST(regexp_extract({c}, '(\\d+)\\s+Years', 1) AS INT) * 12
  + coalesce(TRY_CAST(regexp_extract({c}, '(\\d+)\\s+Months', 1) AS INT), 0)"""
oracle(
    "credit_history_months",
    f"SELECT row_id, Credit_History_Age, {_MONTHS.format(c='Credit_History_Age')} AS months FROM in_financials",
)
_AGE = f"TRY_CAST(regexp_replace({_blank('Age', fixed.ATTRIBUTE_NULL_TOKENS)}, '[^0-9]', '', 'g') AS INT)"
PARTS["s_att"] = f"""SELECT Customer_ID, Name, CASE WHEN a > 0 AND a < 100 THEN a END AS Age,
  CASE WHEN regexp_matches(SSN, '{fixed.SSN_PATTERN}') THEN SSN END AS SSN,
  {_blank("Occupation", fixed.ATTRIBUTE_NULL_TOKENS)} AS Occupation, snapshot_date
FROM (SELECT *, {_AGE} AS a FROM in_attributes) t WHERE Customer_ID IS NOT NULL AND snapshot_date IS NOT NULL"""
oracle("silver_attributes", "SELECT * FROM s_att")
_TOKENS = ", ".join(f"'{t}'" for t in fixed.NULL_TOKENS)
oracle(
    "silver_clickstream_text",
    "SELECT Customer_ID, CAST(snapshot_date AS DATE) AS snapshot_date, event_id, "
    + ", ".join(
        f"TRY_CAST(trunc(TRY_CAST(CASE WHEN fe_{k} IN ({_TOKENS}) THEN NULL ELSE fe_{k} END AS DOUBLE)) AS INT) AS fe_{k}"
        for k in range(1, 21)
    )
    + " FROM in_clickstream_text WHERE Customer_ID IS NOT NULL AND snapshot_date IS NOT NULL",
)
oracle("silver_clickstream", "SELECT * FROM in_clickstream WHERE Customer_ID IS NOT NULL AND snapshot_date IS NOT NULL")

# --- features ---------------------------------------------------------------------------------------------------


def _completed(source: str) -> str:
    return f"""SELECT * REPLACE (coalesce(Credit_Mix, 'Unknown') AS Credit_Mix, coalesce(Payment_Behaviour, 'Unknown') AS Payment_Behaviour,
  coalesce(Changed_Credit_Limit, 0.0::DOUBLE) AS Changed_Credit_Limit) FROM {source} WHERE Monthly_Balance IS NOT NULL"""


PARTS["c_fin"] = _completed("s_fin")
oracle(
    "impute_defaults_median",
    """SELECT row_id, Credit_Mix, Payment_Behaviour, Changed_Credit_Limit, Monthly_Balance,
  coalesce(Outstanding_Debt, (SELECT quantile_disc(Outstanding_Debt, 0.5) FROM c_fin)) AS Outstanding_Debt FROM c_fin""",
)


def _ratio(top: str, bottom: str) -> str:
    return f"CAST({top} AS DOUBLE) / nullif({bottom} + 1.0::DOUBLE, 0)"


_RATIOS = {
    "log_Annual_Income": "ln(1 + Annual_Income)",
    "debt_to_income": _ratio("Outstanding_Debt", "Annual_Income"),
    "emi_to_salary": _ratio("Total_EMI_per_month", "Monthly_Inhand_Salary"),
    "investment_rate": _ratio("Amount_invested_monthly", "Monthly_Inhand_Salary"),
    "balance_to_debt": _ratio("(Monthly_Balance + 1.0::DOUBLE)", "Outstanding_Debt"),
    "inq_per_loan": _ratio("Num_Credit_Inquiries", "Num_of_Loan"),
}
_RATIO_COLUMNS = ", ".join(f"round({sql}, 6) AS {name}" for name, sql in _RATIOS.items())
_LIMIT_CHANGED = "CAST(Changed_Credit_Limit <> 0 AS INT) AS has_credit_limit_change"
oracle("ratio_features", f"SELECT row_id, {_RATIO_COLUMNS}, {_LIMIT_CHANGED} FROM c_fin")


def _cap(column: str, source: str) -> str:
    def bound(q: float) -> str:
        return f"(SELECT quantile_disc(CAST({column} AS DOUBLE), {q}) FROM {source})"

    return f"""CASE WHEN {column} < {bound(fixed.CAP_LOWER)} THEN {bound(fixed.CAP_LOWER)}
  WHEN {column} > {bound(fixed.CAP_UPPER)} THEN {bound(fixed.CAP_UPPER)} ELSE CAST({column} AS DOUBLE) END AS {column}"""


_CLICKS = ["fe_1", "fe_2", "fe_3"]
oracle(
    "cap_quantiles",
    f"SELECT Customer_ID, snapshot_date, event_id, {', '.join(_cap(c, 'in_clickstream') for c in _CLICKS)} FROM in_clickstream",
)
_BANDS = " ".join(f"WHEN Age < {limit} THEN '{name}'" for limit, name in fixed.AGE_GROUPS)


def _grouped(source: str) -> str:
    return f"""SELECT * REPLACE (CASE WHEN Age BETWEEN 18 AND 75 THEN Age END AS Age, coalesce(Occupation, 'Unknown') AS Occupation),
  CASE {_BANDS.replace("Age <", "CASE WHEN Age BETWEEN 18 AND 75 THEN Age END <")} ELSE '{fixed.AGE_GROUP_OLDEST}' END AS Age_group FROM {source}"""


PARTS["g_att"] = _grouped("s_att")
oracle(
    "age_groups",
    "SELECT Customer_ID, snapshot_date, Age, Occupation, Age_group, CASE WHEN Age IS NULL THEN 'Unknown' ELSE Age_group END AS Age_group_known FROM g_att",
)


def _ranked(column: str, source: str) -> str:
    """Category -> 1-based slot by descending frequency, ties alphabetical."""
    return f"""SELECT {column} AS v, row_number() OVER (ORDER BY count(*) DESC, {column}) AS slot FROM {source}
  WHERE {column} IS NOT NULL GROUP BY {column}"""


def _slot(column: str, source: str, table: str) -> str:
    return f"CAST(coalesce((SELECT slot FROM ({_ranked(column, source)}) r WHERE r.v = {table}.{column}), 0) AS INT)"


oracle(
    "index_onehot",
    "SELECT row_id, "
    + ", ".join(
        f"{_slot(c, 's_fin', 't')} AS {c}_slot, (SELECT CAST(count(DISTINCT {c}) AS INT) FROM s_fin) AS {c}_width"
        for c in fixed.FINANCIAL_CATEGORIES
    )
    + " FROM s_fin t",
)
oracle(
    "standard_scale",
    """SELECT vec_id, CAST(dim - 1 AS INT) AS dim, round((v - avg(v) OVER (PARTITION BY dim)) /
  CASE WHEN stddev_pop(v) OVER (PARTITION BY dim) = 0 THEN 1 ELSE stddev_pop(v) OVER (PARTITION BY dim) END, 5) AS scaled
FROM (SELECT vec_id, unnest(generate_series(1, len(embedding))) AS dim, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings) e""",
)
oracle(
    "align_features",
    """SELECT event_id, coalesce(CAST(fe_3 AS DOUBLE), 0) AS fe_3, CAST(fe_1 AS DOUBLE) AS fe_1, 0.0::DOUBLE AS fe_99, CAST(fe_2 AS DOUBLE) AS fe_2,
  'fe_99' AS missing_features, 0.25::DOUBLE AS missing_ratio, 'fe_1,fe_2,fe_3' AS numeric_features, 'fe_1,fe_2,fe_3' AS click_features FROM in_clickstream""",
)

# --- joins ------------------------------------------------------------------------------------------------------


def _offset(source: str) -> str:
    return f"""SELECT f.* RENAME (snapshot_date AS feature_snapshot_date), l.loan_id, l.label, l.snapshot_date AS label_snapshot_date
FROM {source} f JOIN labels_3 l ON f.Customer_ID = l.Customer_ID AND l.snapshot_date = CAST(f.snapshot_date + INTERVAL 3 MONTH AS DATE)"""


PARTS["o_fin"] = _offset("s_fin")
PARTS["o_att"] = _offset("s_att")
PARTS["o_clk"] = _offset("in_clickstream_m")
_PAIR = "Customer_ID, row_id, feature_snapshot_date, label_snapshot_date, label"
oracle("offset_snapshot_join", f"SELECT {_PAIR}, Annual_Income FROM o_fin")
oracle(
    "training_set_bounded",
    f"SELECT {_PAIR} FROM o_fin WHERE feature_snapshot_date <= DATE '1998-06-01' AND label_snapshot_date <= DATE '1998-06-01'",
)
oracle(
    "label_join_customer_only",
    """SELECT f.Customer_ID, f.row_id, f.snapshot_date AS feature_snapshot_date, l.loan_id, l.label, l.snapshot_date
FROM s_fin f JOIN labels_3 l ON f.Customer_ID = l.Customer_ID WHERE f.snapshot_date = DATE '1997-06-01'""",
)
PARTS["left_features"] = """SELECT l.*, f.fe_1, f.fe_2, f.fe_3 FROM labels_3 l
LEFT JOIN in_clickstream_m f ON l.Customer_ID = f.Customer_ID AND l.snapshot_date = f.snapshot_date"""
oracle("label_left_features", "SELECT * FROM left_features")
oracle(
    "slice_coverage",
    """SELECT f.snapshot_date, CAST(f.snapshot_date + INTERVAL 3 MONTH AS DATE) AS label_snapshot_date, count(*) AS feature_rows,
  (SELECT count(*) FROM labels_3 l WHERE l.snapshot_date = CAST(f.snapshot_date + INTERVAL 3 MONTH AS DATE)) AS label_rows,
  CAST(f.snapshot_date + INTERVAL 3 MONTH AS DATE) IN (SELECT snapshot_date FROM labels_3) AS covered
FROM in_financials f GROUP BY f.snapshot_date""",
)
oracle(
    "repeated_keys",
    "SELECT Customer_ID, snapshot_date, count(*) AS rows FROM in_financials GROUP BY 1, 2 HAVING count(*) > 1",
)
oracle(
    "repeated_slices",
    "\nUNION ALL\n".join(
        f"SELECT '{name}' AS source, Customer_ID, snapshot_date, count(*) AS rows FROM {part} GROUP BY 2, 3 HAVING count(*) > 1"
        for name, part in (("financials", "s_fin"), ("attributes", "s_att"), ("clickstream", "in_clickstream_m"))
    ),
)
PARTS["oc_fin"] = _completed("o_fin")
PARTS["od_fin"] = (
    "SELECT * REPLACE (coalesce(Outstanding_Debt, (SELECT quantile_disc(Outstanding_Debt, 0.5) FROM oc_fin)) AS Outstanding_Debt, "
    + ", ".join(_cap(c, "oc_fin") for c in fixed.CAPPED_FINANCIALS)
    + ") FROM oc_fin"
)
_KEPT = [
    "Changed_Credit_Limit",
    "Credit_Utilization_Ratio",
    "Monthly_Balance",
    *fixed.CAPPED_FINANCIALS,
]
PARTS["p_fin"] = f"""SELECT {_PAIR}, loan_id, {", ".join(f"round({c}, 6) AS {c}" for c in _KEPT)}, {_MONTHS.format(c="Credit_History_Age")} AS credit_history_months,
  CAST(coalesce(len(Loan_Types_Array), -1) AS INT) AS num_loan_types, {_RATIO_COLUMNS}, {_LIMIT_CHANGED},
  {", ".join(f"{_slot(c, 'oc_fin', 't')} AS {c}_slot" for c in fixed.FINANCIAL_CATEGORIES)} FROM od_fin t"""
PARTS["og_att"] = _grouped("o_att")
PARTS["p_att"] = f"""SELECT Customer_ID, loan_id, feature_snapshot_date, label_snapshot_date, label,
  {", ".join(f"{_slot(c, 'og_att', 't')} AS {c}_slot" for c in fixed.ATTRIBUTE_CATEGORIES)} FROM og_att t"""
PARTS["p_clk"] = f"""SELECT Customer_ID, loan_id, feature_snapshot_date, label_snapshot_date, label,
  {", ".join(_cap(c, "o_clk") for c in _CLICKS)} FROM o_clk"""
oracle(
    "feature_store",
    """SELECT * EXCLUDE (label, label_snapshot_date) FROM p_fin
JOIN p_att USING (Customer_ID, loan_id, feature_snapshot_date, label_snapshot_date, label)
JOIN p_clk USING (Customer_ID, loan_id, feature_snapshot_date, label_snapshot_date, label)""",
)

# --- calendars, splits ------------------------------------------------------------------------------------------

PARTS["months"] = """SELECT CAST(unnest(generate_series(date_trunc('month', min(o_orderdate)), max(o_orderdate), INTERVAL 1 MONTH)) AS DATE) AS m FROM orders"""
oracle("month_calendar", "SELECT m AS snapshot_date FROM months")
_FREQUENCY = """SELECT '{f}' AS frequency, CAST(unnest(generate_series(a, a + INTERVAL 3 MONTH, INTERVAL {step})) AS DATE) AS inference_date
FROM (SELECT date_trunc('day', min(ts)) AS a FROM events) t"""
oracle(
    "batch_calendar",
    "\nUNION ALL\n".join(
        _FREQUENCY.format(f=f, step=s) for f, s in (("daily", "1 DAY"), ("weekly", "7 DAY"), ("monthly", "1 MONTH"))
    ),
)
oracle(
    "time_split",
    """SELECT split, count(*) AS rows, round(avg(label), 6) AS base_rate FROM (SELECT label,
  CASE WHEN snapshot_date BETWEEN DATE '1998-07-01' AND DATE '1998-08-31' THEN 'oot'
       WHEN snapshot_date BETWEEN DATE '1997-07-01' AND DATE '1998-06-30' THEN 'train_test' END AS split FROM labels_3) t
WHERE split IS NOT NULL GROUP BY split""",
)


def _fraction(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 8))::BIGINT / 4294967296.0"


_ROW = "concat_ws('|', Customer_ID, event_id)"
_SIDE = f"CASE WHEN {_fraction(_ROW)} < 0.8 THEN 'train' ELSE 'test' END"
oracle("hash_split", f"SELECT event_id, {_SIDE} AS split FROM in_predictions")
oracle(
    "stratified_split",
    f"""SELECT event_id, label, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY md5({_ROW}), Customer_ID, event_id) - 1
  < round(count(*) OVER (PARTITION BY label) * 0.8) THEN 'train' ELSE 'test' END AS split FROM in_predictions""",
)
oracle(
    "oot_thirds",
    f"""SELECT event_id, part FROM (SELECT event_id, CAST(floor((row_number() OVER (ORDER BY md5({_ROW}), Customer_ID, event_id) - 1)
  / (count(*) OVER () // 3)) + 1 AS INT) AS part FROM in_predictions WHERE {_SIDE} = 'test') t WHERE part <= 3""",
)

# --- monitoring -------------------------------------------------------------------------------------------------

PARTS["preds"] = """SELECT Customer_ID, event_id, snapshot_date, model_predictions AS p, CAST(model_predictions > 0.5 AS INT) AS c, label FROM in_predictions"""
oracle(
    "performance_trend",
    """SELECT snapshot_date, round_even(round((avg(p)) * 10000, 4), 0) / 10000 AS avg_probability, round_even(round((stddev_samp(p)) * 10000, 4), 0) / 10000 AS std_probability,
  count(p) AS prediction_count, round_even(round((avg(c)) * 10000, 4), 0) / 10000 AS positive_rate FROM preds GROUP BY snapshot_date""",
)
oracle(
    "distribution_by_period",
    """SELECT snapshot_date, count(p) AS count, round_even(round((avg(p)) * 10000, 4), 0) / 10000 AS mean, round_even(round((stddev_samp(p)) * 10000, 4), 0) / 10000 AS std, round_even(round((min(p)) * 10000, 4), 0) / 10000 AS min,
  round_even(round((max(p)) * 10000, 4), 0) / 10000 AS max, round_even(round((quantile_cont(p, 0.25)) * 10000, 4), 0) / 10000 AS q25, round_even(round((quantile_cont(p, 0.5)) * 10000, 4), 0) / 10000 AS median,
  round_even(round((quantile_cont(p, 0.75)) * 10000, 4), 0) / 10000 AS q75 FROM preds GROUP BY snapshot_date""",
)


def _share(condition: str) -> str:
    return f"avg(CASE WHEN {condition} THEN 1.0::DOUBLE ELSE 0 END)"


_CV = "round_even(round((stddev_samp(p) / avg(p)) * 10000, 4), 0) / 10000"
oracle(
    "prediction_concentration",
    f"""SELECT {_CV} AS overall_coefficient_of_variation, round({_share("p < 0.1")}, 6) AS below_0_1,
  round({_share("p >= 0.1 AND p < 0.5")}, 6) AS between_0_1_0_5, round({_share("p >= 0.5")}, 6) AS above_0_5 FROM preds""",
)
_CONSISTENCY = "(SELECT round_even(round((1 / (1 + stddev_samp(m))) * 10000, 4), 0) / 10000 FROM (SELECT avg(p) AS m FROM preds GROUP BY snapshot_date) d)"
oracle(
    "confidence_metrics",
    f"""SELECT round_even(round(({_share("p < 0.2 OR p > 0.8")}) * 10000, 4), 0) / 10000 AS high_confidence_predictions,
  round_even(round(({_share("p >= 0.2 AND p <= 0.8")}) * 10000, 4), 0) / 10000 AS medium_confidence_predictions, {_CONSISTENCY} AS temporal_consistency,
  round_even(round((avg(p)) * 10000, 4), 0) / 10000 AS average_prediction_confidence, round_even(round((stddev_samp(p)) * 10000, 4), 0) / 10000 AS confidence_std FROM preds""",
)
oracle(
    "stability_metrics",
    f"""SELECT round_even(round((avg(p)) * 10000, 4), 0) / 10000 AS overall_mean, round_even(round((stddev_samp(p)) * 10000, 4), 0) / 10000 AS overall_std, count(*) AS prediction_count,
  round_even(round((avg(c)) * 10000, 4), 0) / 10000 AS positive_prediction_rate, {_CV} AS coefficient_of_variation, {_CV} < 0.5 AS is_stable FROM preds""",
)
oracle(
    "monitoring_period",
    """SELECT concat(CAST(min(snapshot_date) AS VARCHAR), ' to ', CAST(max(snapshot_date) AS VARCHAR)) AS monitoring_period,
  count(*) AS total_predictions_analyzed FROM preds""",
)
oracle(
    "run_statistics",
    f"""SELECT count(p) AS count, round(avg(p), 6) AS mean, round(stddev_pop(p), 6) AS std, min(p) AS min, max(p) AS max,
  round({_share("p > 0.5")}, 6) AS positive_rate FROM preds""",
)
oracle(
    "rollup_by_snapshot",
    """SELECT snapshot_date, count(*) AS n, count(p) AS scored, round_even(round((avg(p)) * 10000, 4), 0) / 10000 AS mean,
  round_even(round((stddev_samp(p)) * 10000, 4), 0) / 10000 AS std, CAST(sum(c) AS BIGINT) AS positives, count(*) FILTER (p < 0.1) AS below_0_1, count(*) FILTER (p >= 0.1 AND p < 0.5) AS between_0_1_0_5,
  count(*) FILTER (p >= 0.5) AS above_0_5, count(*) FILTER (p < 0.2 OR p > 0.8) AS high_confidence,
  count(*) FILTER (p >= 0.2 AND p <= 0.8) AS medium_confidence FROM preds GROUP BY snapshot_date""",
)
PARTS["halves"] = f"""SELECT p, row_number() OVER (ORDER BY snapshot_date, md5({_ROW}), p) <= count(*) OVER () // 2 AS early FROM preds"""
PARTS["drifts"] = """SELECT avg(p) FILTER (early) AS em, stddev_samp(p) FILTER (early) AS es, avg(p) FILTER (NOT early) AS rm,
  stddev_samp(p) FILTER (NOT early) AS rs FROM halves"""
oracle(
    "drift_detection",
    """SELECT abs(rm - em) > 0.1 OR abs(rs - es) > 0.1 AS drift_detected, round_even(round((abs(rm - em)) * 10000, 4), 0) / 10000 AS mean_difference,
  round_even(round((abs(rs - es)) * 10000, 4), 0) / 10000 AS std_difference, 0.1::DOUBLE AS drift_threshold, round_even(round((em) * 10000, 4), 0) / 10000 AS early_mean, round_even(round((es) * 10000, 4), 0) / 10000 AS early_std,
  round_even(round((rm) * 10000, 4), 0) / 10000 AS recent_mean, round_even(round((rs) * 10000, 4), 0) / 10000 AS recent_std FROM drifts""",
)
oracle(
    "confidence_histogram",
    """SELECT CAST(CASE WHEN p < 0 THEN 0 WHEN p >= 1 THEN 31 ELSE floor(p * 30) + 1 END AS BIGINT) AS bin, count(*) AS predictions FROM preds GROUP BY 1""",
)


def _auc(source: str, by: str, score: str, label: str) -> str:
    """Rank-sum AUC with mean ranks for ties."""
    over = f"PARTITION BY {by}" if by else ""
    ties = f"PARTITION BY {by}, {score}" if by else f"PARTITION BY {score}"
    keys = f"{by}, " if by else ""
    return f"""SELECT {keys}CAST(sum(y) AS BIGINT) AS positives, CAST(sum(1 - y) AS BIGINT) AS negatives,
  (sum(y * r) - sum(y) * (sum(y) + 1) / 2) / nullif(CAST(sum(y) AS DOUBLE) * sum(1 - y), 0) AS auc
FROM (SELECT {keys}{label} AS y, rank() OVER ({over} ORDER BY {score}) + (count(*) OVER ({ties}) - 1) / 2.0::DOUBLE AS r FROM {source}) t
{f"GROUP BY {by}" if by else ""}"""


_GINI = "round_even(round((2 * auc - 1) * 1000, 5), 0) / 1000 AS gini"
PARTS["day_auc"] = _auc("preds", "snapshot_date", "p", "label")
oracle("auc_gini_by_period", f"SELECT snapshot_date, positives, negatives, round(auc, 6) AS auc, {_GINI} FROM day_auc")
oracle("average_period_auc", "SELECT count(auc) AS periods, round(avg(auc), 6) AS oot_avg FROM day_auc")
PARTS["text_auc"] = _auc("(SELECT n_chars, quality FROM documents JOIN labels USING (doc_id)) d", "", "n_chars", "quality")
oracle("auc_text_length_quality", f"SELECT positives, negatives, round(auc, 6) AS auc, {_GINI} FROM text_auc")
PARTS["versions"] = """SELECT *, concat('credit_model_', CAST(CAST(Customer_ID AS BIGINT) % 3 AS VARCHAR)) AS model_version,
  CAST(date_trunc('week', snapshot_date) AS DATE) AS period FROM preds"""
PARTS["week_auc"] = _auc("versions", "model_version, period", "p", "label")
_RATING = " ".join(f"WHEN {{cv}} < {limit} THEN '{name}'" for limit, name, _ in fixed.OOT_RATINGS)
_RATING = f"CASE {_RATING} WHEN {{cv}} IS NOT NULL THEN '{fixed.OOT_RATING_WORST[0]}' END"
_WORDS = " ".join(f"WHEN '{name}' THEN '{words}'" for _, name, words in fixed.OOT_RATINGS)
_WORDS = f"CASE {{r}} {_WORDS} WHEN '{fixed.OOT_RATING_WORST[0]}' THEN '{fixed.OOT_RATING_WORST[1]}' END"


def _stability(source: str, by: str) -> str:
    return f"""SELECT *, {_RATING.format(cv="cv")} AS rating FROM (SELECT {by}, count(auc) AS periods, avg(auc) AS m, stddev_pop(auc) AS s,
  min(auc) AS lo, max(auc) AS hi, stddev_pop(auc) / nullif(avg(auc), 0) AS cv FROM {source} WHERE auc IS NOT NULL GROUP BY {by}) t"""


PARTS["stable"] = _stability("week_auc", "model_version")
oracle(
    "oot_stability",
    f"""SELECT model_version, periods, round(m, 6) AS average_score, round(s, 6) AS std_deviation, round(cv, 6) AS coefficient_of_variation,
  printf('%.4f - %.4f', lo, hi) AS score_range, round(hi - lo, 6) AS score_spread, rating AS stability_rating,
  {_WORDS.format(r="rating")} AS stability_explanation FROM stable""",
)
PARTS["day_stats"] = """SELECT snapshot_date, count(*) AS n, avg(p) AS m, stddev_samp(p) AS s, avg(c) AS pos FROM preds GROUP BY snapshot_date"""
PARTS["day_drift"] = """SELECT *, abs(m - lag(m) OVER (ORDER BY snapshot_date)) AS d FROM day_stats"""
oracle(
    "threshold_incidents",
    """SELECT count(*) AS periods, count(*) FILTER (auc < 0.75) AS below_performance, count(*) FILTER (auc < 0.70) AS below_critical,
  count(*) FILTER (d > 0.1) AS drift_incidents, round(avg(auc), 6) AS average_auc, round(avg(d), 6) AS average_drift
FROM day_auc JOIN day_drift USING (snapshot_date)""",
)

# --- governance -------------------------------------------------------------------------------------------------

_RULES = [
    ("drift AND diff > 0.15", "CRITICAL: Severe data drift detected - IMMEDIATE RETRAIN REQUIRED"),
    ("drift AND NOT diff > 0.15", "HIGH: Data drift detected - Schedule retrain within 1 week"),
    ("rating = 'POOR'", "CRITICAL: Poor OOT stability during training - Model reliability compromised"),
    ("rating = 'MODERATE'", "MEDIUM: Moderate OOT stability - Monitor closely"),
    ("rating = 'EXCELLENT'", "EXCELLENT: High OOT stability - Model is robust"),
    ("NOT stable AND cv > 1.0", "CRITICAL: High prediction variability - Model stability compromised"),
    ("NOT stable AND coalesce(cv <= 1.0, TRUE)", "MEDIUM: Monitor model stability closely"),
    ("n < 100", "LOW: Insufficient prediction volume for reliable monitoring"),
    ("n > 10000", "HIGH: High prediction volume - Consider model optimization"),
    ("pos > 0.8", "INVESTIGATE: Unusually high positive prediction rate"),
    ("pos < 0.05", "INVESTIGATE: Unusually low positive prediction rate"),
]
_QUIET = "coalesce(" + ", ".join(f"CASE WHEN {c} THEN 0 END" for c, _ in _RULES) + ", 1) = 1"
_ADVICE = "concat_ws(' | ', " + ", ".join(f"CASE WHEN {c} THEN '{t}' END" for c, t in _RULES) + ")"


def _governed(source: str, carried: str) -> str:
    return f"""SELECT {carried}, CASE WHEN {_QUIET} THEN 'CONTINUE: Model performance stable - Continue regular monitoring' ELSE {_ADVICE} END AS recommendations,
  CASE WHEN drift AND diff > 0.15 THEN 'IMMEDIATE' WHEN drift THEN 'HIGH' END AS retrain_urgency,
  CASE WHEN drift AND diff > 0.15 THEN '24-48 hours' WHEN drift THEN '1 week' END AS retrain_timeline,
  CASE WHEN {_QUIET} THEN 'routine_monitoring' WHEN n > 10000 THEN 'optimize_inference_pipeline' WHEN n < 100 THEN 'increase_data_collection'
    WHEN NOT stable AND cv > 1.0 THEN 'investigate_model_degradation' WHEN NOT stable THEN 'increase_monitoring_frequency'
    WHEN rating = 'EXCELLENT' THEN 'standard_monitoring' WHEN rating = 'MODERATE' THEN 'enhanced_monitoring'
    WHEN rating = 'POOR' THEN 'immediate_model_review' END AS action,
  CASE WHEN pos < 0.05 THEN 'feature_distribution_analysis' WHEN pos > 0.8 THEN 'data_quality_check'
    WHEN rating = 'POOR' THEN 'feature_engineering_review' END AS investigation,
  CASE WHEN drift AND diff > 0.15 THEN 'blue_green_deployment' WHEN drift THEN 'canary_deployment'
    WHEN {_QUIET} THEN 'maintain_current_deployment' END AS strategy,
  CASE WHEN drift AND diff > 0.15 THEN 'automated_rollback_on_performance_drop' WHEN drift THEN 'manual_approval_rollback' END AS rollback_plan,
  CASE WHEN NOT stable AND cv > 1.0 THEN 'enhanced_real_time_monitoring' END AS monitoring, rating AS oot_rating FROM {source}"""


PARTS["run_stability"] = _stability("(SELECT 1 AS one, auc FROM day_auc) a", "one")
PARTS["run_row"] = f"""SELECT abs(rm - em) > 0.1 OR abs(rs - es) > 0.1 AS drift, round_even(round((abs(rm - em)) * 10000, 4), 0) / 10000 AS diff, x.*,
  (SELECT rating FROM run_stability) AS rating FROM drifts, (SELECT {_CV} AS cv, {_CV} < 0.5 AS stable, count(*) AS n, round_even(round((avg(c)) * 10000, 4), 0) / 10000 AS pos,
  round_even(round((avg(p)) * 10000, 4), 0) / 10000 AS confidence, {_CONSISTENCY} AS consistency FROM preds) x"""
PARTS["run_rules"] = _governed("run_row", "drift, diff, stable, n, pos, confidence, consistency, cv")
_TRIGGERS = str(fixed.GOVERNANCE_BLOCKS["refresh_triggers"]).replace("'", "''")
oracle(
    "monitoring_row",
    f"""SELECT DATE '2024-02-01' AS snapshot_date, drift AS drift_detected, diff AS mean_difference, stable AS model_stable, n AS prediction_count,
  pos AS positive_rate, recommendations, coalesce(retrain_urgency, 'N/A') AS retrain_urgency, coalesce(retrain_timeline, 'N/A') AS retrain_timeline,
  coalesce(action, 'N/A') AS required_action, coalesce(investigation, 'N/A') AS investigation_needed, coalesce(strategy, 'N/A') AS deployment_strategy,
  coalesce(rollback_plan, 'N/A') AS rollback_plan, '{_TRIGGERS}' AS refresh_triggers, 'credit_model_2024_02_01.pkl' AS model_version,
  confidence AS avg_confidence, consistency AS temporal_consistency, cv AS coefficient_of_variation FROM run_rules""",
)
PARTS["day_parts"] = f"""SELECT * FROM (SELECT *, CAST(floor((row_number() OVER (PARTITION BY snapshot_date ORDER BY md5({_ROW}), Customer_ID, event_id) - 1)
  / (count(*) OVER (PARTITION BY snapshot_date) // 3)) + 1 AS INT) AS part FROM preds) t WHERE part <= 3"""
PARTS["part_auc"] = _auc("day_parts", "snapshot_date, part", "p", "label")
PARTS["day_rating"] = _stability("part_auc", "snapshot_date")
PARTS["day_metrics"] = """SELECT snapshot_date, coalesce(d, 0) > 0.1 AS drift, round_even(round((d) * 10000, 4), 0) / 10000 AS diff, coalesce(round_even(round((x.s / x.m) * 10000, 4), 0) / 10000 < 0.5, FALSE) AS stable,
  round_even(round((x.s / x.m) * 10000, 4), 0) / 10000 AS cv, n, round_even(round((pos) * 10000, 4), 0) / 10000 AS pos, rating FROM day_drift x LEFT JOIN day_rating USING (snapshot_date)"""
PARTS["day_rules"] = _governed("day_metrics", "snapshot_date")
oracle("governance_rules", "SELECT * FROM day_rules")
def _literal(value) -> str:
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else f"{value}"


_BLOCKS = ", ".join(
    f'{_literal(value)} AS "{block}_{name}"' for block, entries in fixed.GOVERNANCE_BLOCKS.items() for name, value in entries.items()
)
oracle(
    "governance_json",
    f"""SELECT snapshot_date, recommendations, retrain_urgency, retrain_timeline, action, investigation, {_BLOCKS}, strategy, rollback_plan,
  monitoring, coalesce(oot_rating, 'UNKNOWN') AS rating, round(coalesce(round(oot_cv, 4), 0), 6) AS oot_cv,
  coalesce({_WORDS.format(r="oot_rating")}, 'N/A') AS explanation FROM day_rules JOIN (SELECT snapshot_date, day_rating.cv AS oot_cv FROM day_metrics LEFT JOIN day_rating USING (snapshot_date)) r USING (snapshot_date)""",
)

# --- batch summaries --------------------------------------------------------------------------------------------

PARTS["days"] = """SELECT CAST(unnest(generate_series(min(snapshot_date), max(snapshot_date) + 7, INTERVAL 1 DAY)) AS DATE) AS snapshot_date FROM preds"""
PARTS["batch"] = """SELECT d.snapshot_date, count(p) AS prediction_count, count(*) FILTER (p > 0.5) AS positive_predictions, coalesce(avg(p), 0) AS avg_probability,
  CASE WHEN count(p) > 0 THEN 'SUCCESS' ELSE concat('FAILED: No feature data found for date ', CAST(d.snapshot_date AS VARCHAR), ' 00:00:00') END AS status
FROM days d LEFT JOIN preds ON preds.snapshot_date = d.snapshot_date GROUP BY d.snapshot_date"""
oracle("batch_summary", "SELECT * REPLACE (round(avg_probability, 6) AS avg_probability) FROM batch")
oracle(
    "batch_rollup",
    """SELECT concat(CAST(min(d.snapshot_date) AS VARCHAR), ' to ', CAST(max(d.snapshot_date) AS VARCHAR)) AS inference_period,
  count(DISTINCT d.snapshot_date) AS total_prediction_periods, count(p) AS total_predictions_generated, round(avg(c), 6) AS overall_positive_rate,
  round(avg(p), 6) AS average_probability, count(DISTINCT preds.snapshot_date) AS successful_runs,
  count(DISTINCT d.snapshot_date) - count(DISTINCT preds.snapshot_date) AS failed_runs
FROM days d LEFT JOIN preds ON preds.snapshot_date = d.snapshot_date""",
)
oracle(
    "success_rate",
    """SELECT CAST(date_trunc('week', snapshot_date) AS DATE) AS week, count(*) FILTER (status = 'SUCCESS') AS successful,
  count(*) FILTER (status <> 'SUCCESS') AS failed, CAST(sum(prediction_count) AS BIGINT) AS predictions,
  round(100.0::DOUBLE * count(*) FILTER (status = 'SUCCESS') / count(*), 6) AS success_rate,
  100.0::DOUBLE * count(*) FILTER (status = 'SUCCESS') / count(*) >= 95 AS on_target FROM batch GROUP BY 1""",
)
oracle(
    "batch_summary_append",
    """SELECT batch.* REPLACE (round(avg_probability, 6) AS avg_probability), 'daily' AS frequency, DATE '2024-01-01' AS batch_start_date, DATE '2024-04-01' AS batch_end_date, run_date
FROM batch, (SELECT unnest([DATE '2024-04-01', DATE '2024-04-02']) AS run_date) r""",
)

# --- registry ---------------------------------------------------------------------------------------------------

PARTS["active"] = """SELECT *, try_strptime(nullif(regexp_extract(model_file, 'credit_model_(\\d{8})\\.pkl', 1), ''), '%Y%m%d')::DATE AS name_date FROM in_registry
WHERE NOT (model_file LIKE '%\\_archived.pkl' ESCAPE '\\' OR model_file LIKE '%\\_retrain.pkl' ESCAPE '\\')"""
PARTS["asked"] = """SELECT m AS execution_date, (year(m) - 1995) * 12 + month(m) - 1 AS months_since_start,
  (SELECT max(name_date) FROM active WHERE name_date < m) AS previous FROM months"""
PARTS["known"] = """SELECT execution_date, CAST(months_since_start AS INT) AS months_since_start, model_file, readable, coalesce(auc, 0) AS auc, coalesce(cv, 0) AS cv,
  auc > 0 AND auc < 0.70 AS b1, auc > 0 AND auc < 0.72 AS b2, coalesce(auc, 0) <= 0 AS b3, coalesce(cv, 0) > 0.08 AS b4
FROM asked LEFT JOIN active ON name_date = previous"""
PARTS["judged"] = """SELECT *, concat_ws(',', CASE WHEN b1 THEN 'auc_critical' END, CASE WHEN b2 THEN 'auc_warning' END, CASE WHEN b3 THEN 'auc_missing' END,
  CASE WHEN b4 THEN 'cv_high' END) AS breaches,
  coalesce(b1, false)::INT + coalesce(b2, false)::INT + b3::INT + b4::INT AS n_breaches FROM known"""
PARTS["decided"] = """SELECT *, CASE WHEN (SELECT count(*) FROM in_registry) = 0 THEN 'no_models' WHEN model_file IS NULL THEN 'no_previous_model'
  WHEN NOT readable THEN 'unreadable_model' WHEN months_since_start < 12 THEN 'grace_period' WHEN n_breaches >= 2 THEN 'threshold'
  WHEN (months_since_start - 12) % 6 = 0 THEN 'periodic' ELSE 'healthy' END AS reason FROM judged"""
oracle(
    "retraining_decision",
    """SELECT execution_date, model_file, months_since_start, breaches, reason,
  CASE WHEN reason IN ('no_models', 'unreadable_model', 'threshold', 'periodic') THEN 'retrain' ELSE 'keep' END AS decision FROM decided""",
)
PARTS["valid_models"] = """SELECT *, CASE WHEN month(model_date) % 4 > 0 THEN
  CAST(model_date + to_months(CAST(2 + month(model_date) % 6 AS INT)) AS DATE) END AS archived_date FROM active WHERE name_date IS NOT NULL"""
PARTS["as_of"] = """SELECT m AS execution_date, (year(m) - 1995) * 12 + month(m) - 1 AS months_since_start,
  (SELECT max(name_date) FROM valid_models WHERE name_date < m AND (archived_date IS NULL OR archived_date > m)) AS previous FROM months"""
PARTS["known_as_of"] = """SELECT execution_date, months_since_start, model_file, readable, auc > 0 AND auc < 0.70 AS b1, auc > 0 AND auc < 0.72 AS b2,
  coalesce(auc, 0) <= 0 AS b3, coalesce(cv, 0) > 0.08 AS b4 FROM as_of LEFT JOIN valid_models ON name_date = previous"""
PARTS["decided_as_of"] = """SELECT *, concat_ws(',', CASE WHEN b1 THEN 'auc_critical' END, CASE WHEN b2 THEN 'auc_warning' END,
  CASE WHEN b3 THEN 'auc_missing' END, CASE WHEN b4 THEN 'cv_high' END) AS breaches, CASE WHEN model_file IS NULL THEN 'no_previous_model'
  WHEN NOT readable THEN 'unreadable_model' WHEN months_since_start < 12 THEN 'grace_period'
  WHEN coalesce(b1, false)::INT + coalesce(b2, false)::INT + b3::INT + b4::INT >= 2 THEN 'threshold'
  WHEN (months_since_start - 12) % 6 = 0 THEN 'periodic' ELSE 'healthy' END AS reason FROM known_as_of"""
oracle(
    "retraining_as_of",
    """SELECT execution_date, model_file, breaches, reason, CASE WHEN reason IN ('unreadable_model', 'threshold', 'periodic') THEN 'retrain'
  ELSE 'keep' END AS decision FROM decided_as_of""",
)
PARTS["timeline"] = """SELECT execution_date, CASE WHEN months_since_start = 0 THEN 'Initial Training' WHEN months_since_start < 12 THEN 'Grace Period'
  WHEN months_since_start % 6 = 0 THEN 'Periodic Retrain' WHEN n_breaches >= 2 AND model_file IS NOT NULL THEN 'Threshold Retrain' ELSE 'No Action' END AS timeline FROM decided"""
oracle(
    "retraining_timeline",
    "SELECT execution_date, timeline, CAST(timeline LIKE '%Retrain%' AS INT) AS retrained FROM timeline",
)
oracle(
    "retraining_trigger_counts",
    """SELECT trigger, count(*) AS dates FROM (
  SELECT unnest([x FOR x IN [CASE WHEN b1 THEN 'auc_critical' END, CASE WHEN b2 THEN 'auc_warning' END, CASE WHEN b3 THEN 'auc_missing' END,
    CASE WHEN b4 THEN 'cv_high' END, CASE WHEN (months_since_start - 12) % 6 = 0 THEN 'schedule' END] IF x IS NOT NULL]) AS trigger
  FROM decided WHERE reason IN ('threshold', 'periodic', 'healthy')
  UNION ALL SELECT 'initial' FROM decided WHERE reason = 'no_models') t GROUP BY trigger""",
)
oracle(
    "retraining_before_after",
    "SELECT model_file, model_date, lag(auc) OVER (ORDER BY model_date) AS auc_before, auc AS auc_after FROM in_registry",
)
oracle(
    "pipeline_path",
    "SELECT count(*) AS models, CASE WHEN count(*) = 0 THEN 'train_model' ELSE 'model_inference' END AS path FROM in_registry WHERE model_file LIKE 'credit_model_%.pkl'",
)
oracle(
    "model_retention",
    "SELECT model_file, CASE WHEN row_number() OVER (ORDER BY model_file DESC) <= 3 THEN 'kept' ELSE 'archived' END AS status FROM in_registry",
)
oracle(
    "best_model",
    """SELECT year, model_file, auc FROM (SELECT year(model_date) AS year, model_file, auc, row_number() OVER (PARTITION BY year(model_date)
  ORDER BY auc DESC, model_file) AS r FROM in_registry WHERE auc IS NOT NULL) t WHERE r = 1""",
)
oracle(
    "model_names",
    f"""SELECT model_file, substr(model_file, 1, length(model_file) - 4) AS stem,
  try_strptime(nullif(regexp_extract(model_file, 'credit_model_(\\d{{8}})\\.pkl', 1), ''), '%Y%m%d')::DATE AS name_date,
  concat('credit_model_', strftime(model_date, '%Y_%m_%d')) AS model_version, {_RATING.format(cv="cv")} AS rating,
  {_WORDS.format(r="(" + _RATING.format(cv="cv") + ")")} AS explanation, round_even(round((2 * auc - 1) * 1000, 5), 0) / 1000 AS gini FROM in_registry""",
)

# --- stores -----------------------------------------------------------------------------------------------------

oracle("bronze_ingest", "SELECT *, (SELECT count(*) FROM in_loans) AS ingested_rows, true AS skipped FROM s_loans")
oracle("bronze_csv_snapshots", "SELECT * FROM in_loans")
oracle(
    "bronze_reconcile",
    "SELECT Customer_ID, event_id, snapshot_date, p AS prediction_probability, c AS prediction_class FROM preds",
)
oracle("slice_union", "SELECT * FROM in_clickstream")
oracle(
    "snapshot_overwrite",
    "SELECT *, CASE WHEN snapshot_date >= DATE '2024-01-16' THEN 2 ELSE 1 END AS run FROM in_predictions",
)
oracle(
    "snapshot_rebuild",
    """SELECT *, CASE WHEN snapshot_date >= DATE '2024-01-16' THEN 2 ELSE 3 END AS run FROM in_predictions
WHERE snapshot_date >= DATE '2024-01-16' OR snapshot_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-09'""",
)
oracle(
    "store_dates_from_paths",
    """SELECT snapshot_date, snapshot_date AS monitoring_date, count(p) AS prediction_count,
  concat(strftime(snapshot_date, '%Y%m%d'), '_063000') AS batch_run_timestamp, snapshot_date + INTERVAL '6 hours 30 minutes' AS run_at
FROM preds GROUP BY snapshot_date""",
)
oracle(
    "store_inventory",
    "SELECT unnest(['monitoring', 'batch']) AS store, count(DISTINCT snapshot_date) AS files, CAST(count(DISTINCT snapshot_date) AS BIGINT) AS records FROM preds",
)

# --- models (the parts that do not depend on a fit) ---------------------------------------------------------------

PARTS["vec"] = f"""SELECT label % 2 AS label, CASE WHEN u < 0.6 THEN 'train' WHEN u < 0.8 THEN 'test' ELSE 'oot' END AS split
FROM (SELECT label, {_fraction("CAST(vec_id AS VARCHAR)")} AS u FROM embeddings) t"""
oracle(
    "model_registry",
    """SELECT 'credit_model_2024_02_01.pkl' AS model_file, DATE '2024-02-01' AS model_date, 'active' AS status, 1 AS feature_count, true AS usable,
  3 AS n_splits, count(*) FILTER (split = 'train') AS train_rows, count(*) FILTER (split = 'test') AS test_rows,
  count(*) FILTER (split = 'oot') AS oot_rows, round_even(avg(label) FILTER (split = 'train'), 2) AS train_base_rate FROM vec""",
)
oracle("reload_check", "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS mismatches FROM embeddings")
oracle(
    "batch_inference_counts",
    """SELECT m AS snapshot_date, count(Customer_ID) AS prediction_count, CASE WHEN count(Customer_ID) > 0 THEN 'SUCCESS'
  ELSE concat('FAILED: No feature data found for date ', CAST(m AS VARCHAR), ' 00:00:00') END AS status
FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '1998-09-01', max(o_orderdate) + INTERVAL 6 MONTH, INTERVAL 1 MONTH)) AS DATE) AS m FROM orders) c
LEFT JOIN in_clickstream_m f ON f.snapshot_date = m GROUP BY m""",
)

_CLASSES = "count(*) FILTER (label = 1) AS positives, count(*) FILTER (label = 0) AS negatives"
_BOTH = "count(*) FILTER (label = 1) > 0 AND count(*) FILTER (label = 0) > 0"


def _checked(model: str, source: str = "vec", more: str = "") -> str:
    return f"""SELECT '{model}' AS model_name, split, {_CLASSES}, {_BOTH} AS learned, {_BOTH} AS gini_follows{more}
FROM {source} GROUP BY split"""


oracle("train_logistic", _checked("logistic_regression", more=", count(*) AS rows_by_formula"))
oracle("train_forest", _checked("random_forest"))
oracle("train_gbt", _checked("boosted_trees"))
oracle("train_mlp", _checked("neural_network"))
_LEARNERS = ("logistic_regression", "random_forest", "boosted_trees")
oracle(
    "model_comparison",
    "\nUNION ALL\n".join(_checked(m, more=", CAST(1 AS BIGINT) AS selected_models") for m in _LEARNERS),
)
oracle(
    "random_search",
    """SELECT CAST(12 AS BIGINT) AS trials, CAST(4 AS BIGINT) AS distinct_points, CAST(12 AS BIGINT) AS rated, CAST(4 AS INT) AS places,
  CAST(1 AS BIGINT) AS best, count(*) AS train_rows, CAST(sum(label) AS BIGINT) AS train_positives FROM vec WHERE split = 'train'""",
)
oracle(
    "trial_ranking",
    """SELECT learner, draw, parameters, round(cv_auc, 6) AS cv_auc, round(cv_std, 6) AS cv_std,
  CAST(row_number() OVER (PARTITION BY learner ORDER BY cv_auc DESC, draw) AS INT) AS place,
  row_number() OVER (PARTITION BY learner ORDER BY cv_auc DESC, draw) = 1 AS best
FROM (SELECT learner, draw, concat('point ', draw) AS parameters, avg(auc) AS cv_auc, stddev_pop(auc) AS cv_std
  FROM (SELECT event_type AS learner, CAST(user_id % 25 AS INT) AS draw, event_id % 3 AS fold, max(floor(value * 1000) / 1000) AS auc
    FROM events WHERE event_id % 7 > 0 GROUP BY 1, 2, 3) t GROUP BY learner, draw HAVING count(auc) = 3) m""",
)
oracle(
    "search_comparison",
    f"""SELECT unnest(['logistic_regression', 'random_forest', 'boosted_trees']) AS model_name, bool_and(ok) AS complete,
  CAST(1 AS BIGINT) AS selected_models FROM (SELECT split, {_BOTH} AS ok FROM vec GROUP BY split) t""",
)
PARTS["credit_rows"] = """SELECT label, CASE WHEN snapshot_date BETWEEN DATE '1998-07-01' AND DATE '1998-08-31' THEN 'oot'
  WHEN snapshot_date BETWEEN DATE '1995-07-01' AND DATE '1998-06-30' THEN 'train_test' END AS split FROM left_features"""
oracle("credit_model_by_split", _checked("logistic_regression", "(SELECT * FROM credit_rows WHERE split IS NOT NULL) t"))
oracle(
    "score_by_table",
    """SELECT Customer_ID, snapshot_date AS feature_snapshot_date, round(1 / (1 + exp(-total)), 9) AS model_predictions,
  CAST(round(1 / (1 + exp(-total)), 9) > 0.5 AS INT) AS prediction_class
FROM (SELECT Customer_ID, snapshot_date, sum(weight * coalesce(value, 0)) AS total FROM (
    SELECT row_number() OVER () AS r, Customer_ID, snapshot_date, unnest(['fe_1', 'fe_2', 'fe_3', '(intercept)']) AS feature,
      unnest([CAST(fe_1 AS DOUBLE), CAST(fe_2 AS DOUBLE), CAST(fe_3 AS DOUBLE), 1.0]) AS value
    FROM (SELECT row_number() OVER () AS n, * FROM in_clickstream_m) t) long
  JOIN (VALUES ('fe_1', 0.031), ('fe_2', -0.02), ('fe_3', 0.007), ('(intercept)', -0.4)) AS w(feature, weight) USING (feature)
  GROUP BY Customer_ID, snapshot_date) s""",
)
oracle(
    "target_resolution",
    "SELECT snapshot_date, 'default_flag' AS target, count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives FROM labels_3 GROUP BY snapshot_date",
)
_SCORED = "Customer_ID, snapshot_date AS feature_snapshot_date, snapshot_date, 'credit_model_1998_09_01.pkl' AS model_name, true AS class_follows"
oracle(
    "score_snapshot",
    f"""SELECT {_SCORED}, 'credit_model_1998_09_01' AS model_version FROM in_clickstream_m WHERE snapshot_date = DATE '1998-09-01'""",
)
oracle(
    "batch_inference",
    f"""SELECT {_SCORED} FROM in_clickstream_m WHERE snapshot_date IN (SELECT CAST(unnest(generate_series(
  date_trunc('month', min(o_orderdate)), max(o_orderdate), INTERVAL 1 MONTH)) AS DATE) FROM orders)""",
)

ORACLES = {name: _with(body) for name, body in ORACLES.items()}
