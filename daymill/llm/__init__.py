"""Operators for training-data corpora: deduplication, filters, tokens, mixing. Nothing else imports this."""
