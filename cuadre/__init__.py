"""Accounts-payable audit reports as Spark DataFrame plans."""
