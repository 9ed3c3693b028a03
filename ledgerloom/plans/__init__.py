"""Whole jobs: building the master, and the gates it must pass."""
