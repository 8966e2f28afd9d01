"""Whole jobs, composed of the operators."""
