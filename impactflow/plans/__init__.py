"""Whole jobs, plan inspection and the registered queries."""
