"""Marts and the analytics on them, composed from the operators."""
