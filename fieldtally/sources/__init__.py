"""Readers, writers and partition bookkeeping."""
