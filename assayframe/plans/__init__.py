"""Operator chains for the three study workflows, and their queries on the driver tables."""
