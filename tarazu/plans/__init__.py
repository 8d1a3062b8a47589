"""Operators composed into whole jobs, and their registered queries."""
