"""DataFrame operators: discovery, cohort, windows, status, strata, changes."""
