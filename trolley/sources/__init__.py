"""Scans, sinks and the star-schema → basket derivation."""
