"""Query catalogue: one key per operator, with its independent SQL."""
