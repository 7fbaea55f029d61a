"""Discrete-time hazards held as plain parameters and scored as column expressions."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from creditframe.functions.scalars import sigmoid, weighted_terms


@dataclass(frozen=True)
class Hazard:
    """A standardised logistic hazard: z = intercept + sum of coef * (x - mean) / scale."""

    intercept: float
    coef: Mapping[str, float]
    mean: Mapping[str, float]
    scale: Mapping[str, float]

    @property
    def features(self) -> list[str]:
        return list(self.coef)

    def terms(self, names, column=F.col) -> Column:
        return weighted_terms(names, self.coef, self.mean, self.scale, column)

    def score(self, column=F.col) -> Column:
        """Hazard probability; ``column`` maps a feature name to its expression."""
        return sigmoid(F.lit(self.intercept) + self.terms(self.features, column))

    def contribution(self, name: str) -> Column:
        """One feature's share of the log-odds, measured from its mean."""
        return self.terms([name])


# Published parameters of the quarterly default hazard.
PUBLISHED_DEFAULT = Hazard(
    intercept=-6.954892014562259,
    coef={
        "loan_age_q": 0.253899,
        "loan_age_q_sq": -0.064737,
        "fico": -0.427612,
        "current_ltv": 0.352582,
        "odti": 0.253613,
        "orig_rate": 0.052371,
        "unemployment_rate": 0.58025,
    },
    mean={
        "loan_age_q": 12.23412,
        "loan_age_q_sq": 290.149051,
        "fico": 730.199637,
        "current_ltv": 74.84806,
        "odti": 35.895404,
        "orig_rate": 5.628725,
        "unemployment_rate": 6.603191,
    },
    scale={
        "loan_age_q": 11.85223,
        "loan_age_q_sq": 557.650639,
        "fico": 55.623467,
        "current_ltv": 21.090737,
        "odti": 11.551719,
        "orig_rate": 0.949671,
        "unemployment_rate": 2.111722,
    },
)
# Constants of the projection and the what-if.
CONSTANT_PREPAY = 0.0165
ASSUMED_LGD = 0.30
START_AGE_Q = 6
BASE_UNEMPLOYMENT = 4.5
HORIZON_Q = 13
HPI_AS_OF = 100.0
LTV_CAP = 250.0
