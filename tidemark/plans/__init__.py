"""Declarative specs, end-to-end runs and the driver's queries."""
