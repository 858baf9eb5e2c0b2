"""Whole-run plans built from the operators."""
