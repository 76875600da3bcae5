"""Operator actions as they arrive."""
