"""Scans, versioned tables and run records."""
