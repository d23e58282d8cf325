"""Operators for preparing training text and vectors on a cluster."""
