"""Whole runs over the operators: frame extraction, training sets, evaluation sets, mask banks."""
