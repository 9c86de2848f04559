"""Plans: the batch pipeline from messages to result tables, and the
reporting queries over those tables."""
