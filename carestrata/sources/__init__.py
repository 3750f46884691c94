"""Scans, sinks and the state kept about them."""
