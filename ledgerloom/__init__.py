"""Spark operators that build, audit and publish a master register of entities."""
