"""Operators: validation (V), per-vehicle folds (D), dense ids (W), comparison."""
