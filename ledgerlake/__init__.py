"""Retail landing, star-schema reporting and near-duplicate retrieval on Spark."""
