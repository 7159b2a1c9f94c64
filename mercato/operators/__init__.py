"""DataFrame operators: quality gates, conformance rules, star schema, marts,
ranking and the read-side (dashboard) queries."""
