"""Logical plans: silver dimensions/facts, gold aggregates, analytical queries."""
