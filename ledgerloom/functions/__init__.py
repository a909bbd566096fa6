"""Column functions: rules, numbers, dates, file names, statistics."""
