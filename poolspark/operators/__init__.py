"""Operators, by stage."""
