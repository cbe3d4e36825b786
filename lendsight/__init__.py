"""Loan-portfolio risk analytics expressed as lazy Spark DataFrame operators."""
