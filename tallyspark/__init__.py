"""Periodic account-statement analytics as Spark DataFrame operators."""
