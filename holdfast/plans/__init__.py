"""Whole jobs: models, cross-validation, search, stacking, interpretation, final evaluation."""
