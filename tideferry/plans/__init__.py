"""Whole jobs: a transfer run, its reports, and the analytic workload."""
