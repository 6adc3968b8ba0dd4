"""Compositions of operators: the layer pipeline, marts and reports."""
