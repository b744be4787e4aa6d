"""Operators for preparing training data; see the README for their contracts."""
