"""Whole workflows, the test fixtures and the registered queries."""
