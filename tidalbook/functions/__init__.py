"""Column functions: normalizing, validating, scoring and status rules."""
