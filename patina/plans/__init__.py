"""Whole workflows: inspect, validate against a spec, and the domain recipes."""
