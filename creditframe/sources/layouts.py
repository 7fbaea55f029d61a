"""Positional layouts of the header-less loan files."""

from __future__ import annotations

from pyspark.sql import types as T

# Field order of the origination file, one row per loan.
ORIGINATION_FIELDS = [
    "credit_score", "first_payment_date", "first_time_homebuyer_flag", "maturity_date", "msa", "mi_pct",
    "num_units", "occupancy_status", "ocltv", "odti", "orig_upb", "oltv", "orig_interest_rate", "channel",
    "ppm_flag", "amortization_type", "property_state", "property_type", "postal_code", "loan_sequence_number",
    "loan_purpose", "orig_loan_term", "num_borrowers", "seller_name", "servicer_name", "super_conforming_flag",
    "pre_harp_loan_seq_number", "program_indicator", "harp_indicator", "property_valuation_method",
    "interest_only_flag", "mi_cancellation_flag",
]
# Field order of the performance file, one row per loan and month.
PERFORMANCE_FIELDS = [
    "loan_sequence_number", "monthly_reporting_period", "current_actual_upb", "current_delinquency_status",
    "loan_age", "remaining_months_to_maturity", "defect_settlement_date", "modification_flag",
    "zero_balance_code", "zero_balance_effective_date", "current_interest_rate", "current_deferred_upb", "ddlpi",
    "mi_recoveries", "net_sales_proceeds", "non_mi_recoveries", "expenses", "legal_costs",
    "maintenance_preservation_costs", "taxes_and_insurance", "miscellaneous_expenses", "actual_loss_calculation",
    "modification_cost", "step_modification_flag", "deferred_payment_plan", "estimated_ltv",
    "zero_balance_removal_upb", "delinquent_accrued_interest", "delinquency_due_to_disaster",
    "borrower_assistance_status", "current_month_modification_cost", "interest_bearing_upb",
]

# File-name patterns per layout, as (loans, performance).
FILE_PATTERNS = {
    "sample": ("sample_orig_[0-9]*.txt", "sample_svcg_[0-9]*.txt"),
    "standard": ("historical_data_[0-9][0-9][0-9][0-9]*.txt", "historical_data_time_[0-9]*.txt"),
    "quarterly": ("historical_data_[0-9]*Q[0-9].txt", "historical_data_time_[0-9]*Q[0-9].txt"),
}

# What a file name must look like for its layout to be taken, in order of precedence.
LAYOUT_MARKS = {
    "sample": r"/sample_orig_[^/]*\.txt$",
    "quarterly": r"/historical_data_time_[^/]*Q[^/]*\.txt$",
    "standard": r"/historical_data_time_[^/]*\.txt$",
}

# Typed columns; everything else in a layout stays text.
INT_FIELDS = {
    "credit_score", "mi_pct", "num_units", "ocltv", "odti", "oltv", "orig_loan_term", "num_borrowers",
    "monthly_reporting_period", "loan_age", "zero_balance_effective_date",
}
DOUBLE_FIELDS = {
    "orig_upb", "orig_interest_rate", "current_actual_upb", "actual_loss_calculation", "net_sales_proceeds",
    "zero_balance_removal_upb",
}

ORIGINATION_COLUMNS = [
    "loan_sequence_number", "credit_score", "first_payment_date", "first_time_homebuyer_flag", "maturity_date",
    "msa", "mi_pct", "num_units", "occupancy_status", "ocltv", "odti", "orig_upb", "oltv", "orig_interest_rate",
    "channel", "amortization_type", "property_state", "property_type", "loan_purpose", "orig_loan_term",
    "num_borrowers", "interest_only_flag",
]
PERFORMANCE_COLUMNS = [
    "loan_sequence_number", "monthly_reporting_period", "current_actual_upb", "current_delinquency_status",
    "loan_age", "zero_balance_code", "zero_balance_effective_date", "actual_loss_calculation",
    "net_sales_proceeds", "zero_balance_removal_upb",
]


def text_schema(fields: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in fields])
