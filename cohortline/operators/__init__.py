"""DataFrame operators: dedup, hit selection and enrichment, policies, cohorts, reconciliation, loads."""
