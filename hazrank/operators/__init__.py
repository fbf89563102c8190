"""Operators: ranking and top-k evaluation, feature transforms, model
selection, grid handling, models, exploratory queries."""
