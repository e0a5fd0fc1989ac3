"""Whole jobs: the incremental archive run and the registered queries."""
