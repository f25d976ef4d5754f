"""Compositions of the operators, and the registry of checked queries."""
