"""Operators: plain functions from DataFrame to DataFrame, lazy, no I/O."""
