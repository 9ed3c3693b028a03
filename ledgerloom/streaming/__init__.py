"""Incremental publishing of the profile feed."""
