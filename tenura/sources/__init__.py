"""Sources of the attrition engine."""
