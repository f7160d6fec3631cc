"""Streaming of the attrition engine."""
