"""Blocking, retrieval, pair features, decisions, models and validation."""
