"""Operators of the attrition engine."""
