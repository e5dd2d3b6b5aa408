"""Readers. Credentials come from the Spark configuration only."""
