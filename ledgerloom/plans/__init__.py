"""Query plans: wallet sizing, cash cycle, filings, diagnostics."""
