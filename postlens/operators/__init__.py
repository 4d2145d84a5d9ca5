"""Operators over whole frames."""
