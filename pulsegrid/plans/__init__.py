"""Composite jobs: the wide user-day table and its refresh."""
