"""Sources, sinks and the test views that stand in for the ledgers."""
