"""Whole-table jobs: extract, page, reconcile."""
