"""Whole review levels composed from the operators."""
