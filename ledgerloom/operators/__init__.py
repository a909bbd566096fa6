"""DataFrame operators shared by the plans: as-of join, top rows, containment join, deduplication."""
