"""Fixed values.

Everything in this module is vocabulary or a threshold that stored data, stored models or stored reports depend
on; results are only right when these values are exactly as listed.
"""

# --- Fixed values: source columns ------------------------------------------------------------------------------
NULL_TOKENS = ["_", "NA", "na", "N/A"]
ATTRIBUTE_NULL_TOKENS = NULL_TOKENS + ["_______"]

LEDGER_TYPES = {
    "loan_id": "string",
    "Customer_ID": "string",
    "loan_start_date": "date",
    "tenure": "int",
    "installment_num": "int",
    "loan_amt": "double",
    "due_amt": "double",
    "paid_amt": "double",
    "overdue_amt": "double",
    "balance": "double",
    "snapshot_date": "date",
}

# Dirty numeric text: which characters carry the number, and the type it becomes.
FINANCIAL_NUMBERS = {
    "Annual_Income": ("0-9.", "double"),
    "Monthly_Inhand_Salary": ("0-9.-", "double"),
    "Monthly_Balance": ("0-9.-", "double"),
    "Outstanding_Debt": ("0-9.-", "double"),
    "Amount_invested_monthly": ("0-9.", "double"),
    "Changed_Credit_Limit": ("0-9.-", "double"),
    "Total_EMI_per_month": ("0-9.-", "double"),
    "Credit_Utilization_Ratio": ("0-9.-", "double"),
    "Num_Bank_Accounts": ("0-9-", "int"),
    "Num_Credit_Card": ("0-9-", "int"),
    "Interest_Rate": ("0-9-", "int"),
    "Num_of_Loan": ("0-9", "int"),
    "Num_of_Delayed_Payment": ("0-9", "int"),
    "Num_Credit_Inquiries": ("0-9-", "int"),
}

PAYMENT_BEHAVIOURS = [
    "High_spent_Large_value_payments",
    "High_spent_Medium_value_payments",
    "High_spent_Small_value_payments",
    "Low_spent_Large_value_payments",
    "Low_spent_Medium_value_payments",
    "Low_spent_Small_value_payments",
]
SSN_PATTERN = r"^\d{3}-\d{2}-\d{4}$"
LOAN_TYPE_SEPARATOR = ", |, and "
LOAN_TYPE_SEPARATOR_CLEAN = r",\s+(?:and\s+)?"

# --- Fixed values: features ------------------------------------------------------------------------------------
CAPPED_FINANCIALS = [
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Interest_Rate",
    "Num_of_Delayed_Payment",
    "Num_Credit_Inquiries",
]
CAP_LOWER, CAP_UPPER = 0.01, 0.95
FINANCIAL_CATEGORIES = ["Credit_Mix", "Payment_Behaviour", "Payment_of_Min_Amount"]
ATTRIBUTE_CATEGORIES = ["Occupation", "Age_group"]
AGE_GROUPS = [(25, "<25"), (40, "25–39"), (60, "40–59")]
AGE_GROUP_OLDEST = "60+"

# Columns that never enter the feature store: the target, personal data, and sources of engineered features.
WITHHELD_COLUMNS = [
    "label",
    "label_snapshot_date",
    "Name",
    "SSN",
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Outstanding_Debt",
    "Total_EMI_per_month",
    "Amount_invested_monthly",
    "Age",
    "Num_of_Loan",
    "Type_of_Loan",
    "Loan_Types_Array",
    "Credit_History_Age",
    "Credit_Mix",
    "Payment_Behaviour",
    "Payment_of_Min_Amount",
]
TARGET_NAMES = ["target", "label", "default_flag", "bad_flag"]

# --- Fixed values: monitoring thresholds -----------------------------------------------------------------------
DRIFT_THRESHOLD = 0.1
PERFORMANCE_THRESHOLD = 0.75
CRITICAL_AUC = 0.70
WARNING_AUC = 0.72
RETRAIN_CV = 0.08
STABLE_BELOW_CV = 0.5
SUCCESS_RATE_TARGET = 95
OOT_RATINGS = [
    (0.02, "EXCELLENT", "Very consistent performance across all OOT periods"),
    (0.05, "GOOD", "Good consistency with minor variations"),
    (0.1, "MODERATE", "Moderate consistency with some variation"),
]
OOT_RATING_WORST = ("POOR", "High variation - potential stability concerns")

# --- Fixed values: governance document (constant blocks) -------------------------------------------------------
GOVERNANCE_BLOCKS = {
    "refresh_triggers": {
        "performance_degradation": "AUC drops below 0.75",
        "data_drift": "Distribution shift > 0.1",
        "stability_loss": "Coefficient of variation > 0.5",
        "oot_instability": "OOT CV > 0.1",
        "business_rules": "Quarterly mandatory refresh",
    },
    "refresh_process": {
        "data_validation": "Validate new training data quality",
        "model_training": "Train with 3 OOT periods (6 months)",
        "oot_validation": "Ensure OOT CV < 0.05 for stability",
        "backtesting": "Test on additional holdout period",
        "approval_workflow": "Model committee approval required",
        "deployment_approval": "Risk management sign-off",
    },
    "model_versioning": {
        "naming_convention": "credit_model_YYYY_MM_DD",
        "artifact_storage": "model_bank/ with 3 OOT metadata",
        "rollback_retention": "Keep last 3 model versions",
        "performance_benchmark": "Compare 3 OOT stability vs previous model",
    },
    "3_oot_requirements": {
        "minimum_periods": 3,
        "period_length": "2 months each",
        "stability_threshold": "CV < 0.05",
        "minimum_auc": "0.72 per period",
        "retraining_frequency": "6 months (for excellent stability)",
        "early_warning_cv": 0.03,
    },
}
