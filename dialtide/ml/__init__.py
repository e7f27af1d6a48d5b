"""Churn models: preparation, training, tuning, scoring and explanation."""
