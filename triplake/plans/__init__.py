"""Whole jobs: from sources through operators to tables."""
