"""Column helpers: cleaners, ladders, and name keys."""
