"""The relational query surface over the results table."""
