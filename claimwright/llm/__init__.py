"""Operators for building training data from raw text, and their registered queries."""
