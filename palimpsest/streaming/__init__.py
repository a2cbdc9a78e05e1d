"""Arriving units, taken once each."""
