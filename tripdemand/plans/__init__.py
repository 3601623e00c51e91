"""End-to-end plans: batch job, reports, test-data fixtures and the query registry."""
