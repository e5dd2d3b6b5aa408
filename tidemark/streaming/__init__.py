"""Sinks and life cycle of streaming queries."""
