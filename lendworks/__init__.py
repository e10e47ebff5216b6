"""Loan-portfolio lakehouse operators expressed as Spark DataFrame transformations."""
