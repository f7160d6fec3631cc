"""Plans of the attrition engine."""
