"""Credit-shaped inputs derived from the TPC-H-like test tables.

Each adapter is one SQL text that Spark and DuckDB both run unchanged, so the Spark queries and their oracles start
from the same rows.  ``{name}`` stands for an input table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

ADAPTERS = {
    # Instalment ledger: repeated (loan, instalment) pairs, zero due amounts, missing balances.
    "loans": """
SELECT CAST(l_orderkey AS STRING) AS loan_id, CAST(o_custkey AS STRING) AS Customer_ID,
  CAST(o_orderdate AS DATE) AS loan_start_date, 7 AS tenure, l_linenumber AS installment_num,
  o_totalprice AS loan_amt, due_amt,
  CASE WHEN l_returnflag = 'R' THEN due_amt * (l_linenumber % 4) + (CASE WHEN l_quantity = 1 THEN 5 ELSE 0 END)
       WHEN l_returnflag = 'A' THEN due_amt * l_discount * 10 ELSE CAST(0 AS DOUBLE) END AS overdue_amt,
  due_amt / 2 AS paid_amt, CASE WHEN l_orderkey % 20 = 0 THEN NULL ELSE o_totalprice - l_extendedprice END AS balance,
  CAST(date_trunc('month', l_shipdate) AS DATE) AS snapshot_date
FROM (SELECT l.*, CASE WHEN l_quantity = 1 THEN CAST(0 AS DOUBLE) ELSE l_extendedprice / 10 END AS due_amt FROM {lineitem} l) x
JOIN {orders} ON l_orderkey = o_orderkey""",
    # Monthly financial statements as dirty text; row_id is unique.
    "financials": """
SELECT CAST(o_custkey AS STRING) AS Customer_ID, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date, o_orderkey AS row_id,
  concat(CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING), CASE WHEN o_orderkey % 7 = 0 THEN '_' ELSE '' END) AS Annual_Income,
  CAST(floor(o_totalprice / 12) AS DOUBLE) AS Monthly_Inhand_Salary,
  CASE WHEN o_orderkey % 17 = 0 THEN '_' ELSE concat(CAST(CAST(floor(c_acctbal) AS BIGINT) AS STRING), CASE WHEN o_orderkey % 5 = 0 THEN '__' ELSE '' END) END AS Monthly_Balance,
  CASE WHEN o_orderkey % 19 = 0 THEN 'N/A' ELSE concat(CAST(o_orderkey % 5000 AS STRING), '_') END AS Outstanding_Debt,
  CASE WHEN o_orderkey % 23 = 0 THEN '__10000__' ELSE CAST(o_orderkey % 800 AS STRING) END AS Amount_invested_monthly,
  CASE WHEN o_orderkey % 6 = 0 THEN '_' WHEN o_orderkey % 4 = 0 THEN '0' ELSE concat('-', CAST(o_orderkey % 20 AS STRING)) END AS Changed_Credit_Limit,
  CAST(o_orderkey % 300 AS STRING) AS Total_EMI_per_month, CAST(20 + o_orderkey % 30 AS STRING) AS Credit_Utilization_Ratio,
  CASE WHEN o_orderkey % 29 = 0 THEN '-1' ELSE CAST(o_orderkey % 12 AS STRING) END AS Num_Bank_Accounts,
  CAST(o_orderkey % 11 AS STRING) AS Num_Credit_Card, CAST(CASE WHEN o_orderkey % 50 = 0 THEN 5000 ELSE o_orderkey % 34 END AS STRING) AS Interest_Rate,
  CASE WHEN o_orderkey % 11 = 0 THEN '-100' WHEN o_orderkey % 13 = 0 THEN 'NA' ELSE CAST(o_orderkey % 9 AS STRING) END AS Num_of_Loan,
  CASE WHEN o_orderkey % 14 = 0 THEN concat(CAST(o_orderkey % 25 AS STRING), '_') ELSE CAST(o_orderkey % 25 AS STRING) END AS Num_of_Delayed_Payment,
  CAST(o_orderkey % 15 AS STRING) AS Num_Credit_Inquiries,
  CASE WHEN o_orderkey % 13 = 0 THEN 'NA' WHEN o_orderkey % 3 = 0 THEN concat(CAST(o_orderkey % 30 AS STRING), ' Years') ELSE concat(CAST(o_orderkey % 30 AS STRING), ' Years and ', CAST(o_orderkey % 12 AS STRING), ' Months') END AS Credit_History_Age,
  CASE o_orderkey % 4 WHEN 0 THEN 'Auto Loan, Home Loan, and Payday Loan' WHEN 1 THEN 'Auto Loan' WHEN 2 THEN 'Not Specified, and Student Loan' ELSE NULL END AS Type_of_Loan,
  CASE WHEN o_orderkey % 10 = 0 THEN '!@9#%8' WHEN o_orderkey % 2 = 0 THEN 'High_spent_Small_value_payments' ELSE 'Low_spent_Large_value_payments' END AS Payment_Behaviour,
  CASE WHEN o_orderkey % 8 = 0 THEN '_' ELSE c_mktsegment END AS Credit_Mix,
  CASE o_orderkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'NM' END AS Payment_of_Min_Amount
FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    # Customer attributes with dirty age, identity number and occupation; unique per customer and month.
    "attributes": """
SELECT CAST(c_custkey AS STRING) AS Customer_ID, c_name AS Name,
  CASE WHEN c_custkey % 9 = 0 THEN '-500' WHEN c_custkey % 5 = 0 THEN concat(CAST(14 + c_custkey % 70 AS STRING), '_') ELSE CAST(14 + c_custkey % 70 AS STRING) END AS Age,
  CASE WHEN c_custkey % 6 = 0 THEN '#F%$D@*&8' ELSE concat(CAST(100 + c_custkey % 900 AS STRING), '-', CAST(10 + c_custkey % 90 AS STRING), '-', CAST(1000 + c_custkey % 9000 AS STRING)) END AS SSN,
  CASE WHEN c_custkey % 7 = 0 THEN '_______' ELSE c_mktsegment END AS Occupation,
  m.snapshot_date
FROM {customer} JOIN (SELECT DISTINCT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date FROM {orders}) m ON c_custkey = m.o_custkey""",
    # Daily click features, one with NULLs, one with negatives.
    "clickstream": """
SELECT CAST(user_id AS STRING) AS Customer_ID, CAST(ts AS DATE) AS snapshot_date, event_id,
  CAST(floor(value) AS INT) AS fe_1, CAST(floor(value * 7) AS INT) % 101 - 50 AS fe_2,
  CASE WHEN event_id % 10 = 0 THEN NULL ELSE CAST(event_id % 97 AS INT) END AS fe_3
FROM {events}""",
    # All twenty click features as dirty text: placeholders, blanks, decimals, overflow and words; keys may be missing.
    "clickstream_text": """
SELECT CASE WHEN event_id % 41 = 0 THEN NULL ELSE CAST(user_id AS STRING) END AS Customer_ID,
  CASE WHEN event_id % 43 = 0 THEN NULL ELSE CAST(CAST(ts AS DATE) AS STRING) END AS snapshot_date, event_id,
  """
    + ",\n  ".join(
        f"""CASE (event_id + {k}) % 23 WHEN 0 THEN '_' WHEN 1 THEN 'NA' WHEN 2 THEN 'na' WHEN 3 THEN 'N/A' WHEN 4 THEN '' WHEN 5 THEN 'x{k}'
    WHEN 6 THEN '99999999999' WHEN 7 THEN concat(CAST(event_id % 50 AS STRING), '.0') ELSE CAST((event_id * {k}) % 211 - 100 AS STRING) END AS fe_{k}"""
        for k in range(1, 21)
    )
    + """
FROM {events}""",
    # Monthly click-style features on the customers of the financial statements.
    "clickstream_m": """
SELECT CAST(o_custkey AS STRING) AS Customer_ID, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date,
  CAST(floor(sum(o_totalprice) / 1000) AS INT) AS fe_1, CAST(count(*) AS INT) AS fe_2, CAST(max(o_orderkey) % 97 AS INT) AS fe_3
FROM {orders} GROUP BY 1, 2""",
    # Model registry, one model per order month.
    "registry": """
SELECT concat('credit_model_', replace(CAST(m AS STRING), '-', ''), CASE WHEN k % 10 = 0 THEN '_retrain' WHEN k % 9 = 0 THEN '_archived' ELSE '' END, '.pkl') AS model_file,
  m AS model_date, CASE WHEN k % 8 = 0 THEN NULL ELSE CAST(65 + k % 16 AS DOUBLE) / 100 END AS auc, CAST(k % 12 AS DOUBLE) / 100 AS cv, k % 13 <> 0 AS readable
FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, count(*) AS k FROM {orders} GROUP BY 1) t""",
    # Stored predictions with an outcome; event_id is unique.
    "predictions": """
SELECT CAST(user_id AS STRING) AS Customer_ID, event_id, CAST(ts AS DATE) AS snapshot_date, value / 500 AS model_predictions,
  CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 2 AS label
FROM {events}""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def adapter(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One credit-shaped input, as a lazy DataFrame over the test tables."""
    text = ADAPTERS[name]
    inputs = {t: table(spark, sf_dir, t) for t in sorted(set(re.findall(r"\{(\w+)\}", text)))}
    return spark.sql(text, **inputs)


def adapter_sql(name: str) -> str:
    """The same input as SQL over views named like the tables."""
    return re.sub(r"\{(\w+)\}", r"\1", ADAPTERS[name]).strip()
