"""Loan-shaped views over the driver's tables, the registered queries and their SQL oracles."""
