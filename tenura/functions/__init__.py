"""Functions of the attrition engine."""
