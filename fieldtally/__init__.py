"""Reporting analytics as composable PySpark DataFrame operators."""
