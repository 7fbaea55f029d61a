"""Scalar column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Outcome codes of the loan files.
DEFAULT_STATUS = 6
CREDIT_EVENT_CODES = ["02", "03", "09", "15"]
PREPAY_CODE = "01"

# Inclusive valid range per origination field; anything outside is a "not known" code.
VALID_RANGE = {
    "credit_score": (300, 850),
    "oltv": (1, 998),
    "ocltv": (1, 998),
    "odti": (1, 65),
    "mi_pct": (0, 55),
    "num_units": (1, 4),
    "num_borrowers": (1, 10),
}


def as_int(text: Column) -> Column:
    """Text to INT, NULL where it is not a whole number."""
    return text.try_cast("int")


def as_double(text: Column) -> Column:
    return text.try_cast("double")


def in_range(name: str) -> Column:
    """The field where it lies in its valid range, else NULL."""
    lo, hi = VALID_RANGE[name]
    return F.when(F.col(name).between(lo, hi), F.col(name))


def round_half_up(value: Column, digits: int) -> Column:
    """Round a rate half up on the binary value; for large money sums use ``F.round`` instead."""
    unit = float(10**digits)
    return F.floor(value.cast("double") * F.lit(unit) + F.lit(0.5)) / F.lit(unit)


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole as DOUBLE, NULL when whole is zero."""
    return F.try_divide(F.lit(100.0) * part, whole.cast("double"))


def mean_percent(flag: Column) -> Column:
    """Share of a 0/1 flag in percent, over the rows where it is known."""
    return percent(F.sum(flag), F.count(flag))


def key_fraction(key: Column, seed: int = 42) -> Column:
    """A number in [0, 1) that depends on the key and the seed only."""
    head = F.substring(F.md5(F.concat(key, F.lit(str(seed))).cast("binary")), 1, 8)
    return F.conv(head, 16, 10).cast("bigint") % F.lit(1_000_000) / F.lit(1_000_000.0)


def quarter_key(yyyymm: Column) -> Column:
    """YYYYMM as a running quarter number, year * 4 + quarter - 1."""
    month = yyyymm % F.lit(100)
    year = ((yyyymm - month) / F.lit(100)).cast("int")
    return (year * F.lit(4) + F.floor((month - F.lit(1)) / F.lit(3)).cast("int")).cast("int")


def quarter_key_of_label(label: Column) -> Column:
    """'YYYYQn' as a running quarter number."""
    return as_int(F.substring(label, 1, 4)) * F.lit(4) + as_int(F.substring(label, 6, 1)) - F.lit(1)


def quarter_label(key: Column) -> Column:
    quarter = key % F.lit(4)
    year = ((key - quarter) / F.lit(4)).cast("int")
    return F.concat(year.cast("string"), F.lit("Q"), (quarter + F.lit(1)).cast("string"))


def vintage_of_key(loan: Column) -> Column:
    """Origination year held in the loan key (F05Q1... -> 2005)."""
    return F.lit(2000) + as_int(F.substring(loan, 2, 2))


def origination_quarter_of_key(loan: Column) -> Column:
    """Running quarter number of the origination quarter held in the loan key."""
    return vintage_of_key(loan) * F.lit(4) + as_int(F.substring(loan, 5, 1)) - F.lit(1)


def current_ltv(oltv: Column, hpi_then: Column, hpi_now: Column, cap: float = 250.0) -> Column:
    """Mark-to-market LTV, capped; an unknown LTV takes the cap because LEAST skips NULL."""
    return F.least(oltv * F.try_divide(hpi_then, hpi_now), F.lit(cap))


def is_credit_event() -> Column:
    return F.col("zero_balance_code").isin(CREDIT_EVENT_CODES)


def is_default_month() -> Column:
    """180+ days late or ended by a credit event, in one performance row."""
    late = as_int(F.col("current_delinquency_status")) >= F.lit(DEFAULT_STATUS)
    return F.coalesce(late, F.lit(False)) | F.coalesce(is_credit_event(), F.lit(False))


def weighted_terms(names, coef, mean, scale, column=F.col) -> Column:
    """Sum of coef * (x - mean) / scale over the named inputs."""
    total = F.lit(0.0)
    for name in names:
        total = total + F.lit(coef[name]) * (column(name) - F.lit(mean[name])) / F.lit(scale[name])
    return total


def sigmoid_of_negative(z: Column) -> Column:
    """1 / (1 + e^z), as a power: a division would test its divisor in generated code every time."""
    return F.pow(F.lit(1.0) + F.exp(z), F.lit(-1.0))


def sigmoid(z: Column) -> Column:
    """1 / (1 + e^-z)."""
    return sigmoid_of_negative(-z)
