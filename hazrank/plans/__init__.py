"""Logical plans of the risk model: timeline, cohorts, labels, features,
feature matrix."""
