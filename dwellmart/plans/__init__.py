"""Whole jobs and reports, composed from operators and sources."""
