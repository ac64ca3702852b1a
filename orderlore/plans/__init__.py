"""Whole jobs built from the operators: feature matrices, training, scoring."""
