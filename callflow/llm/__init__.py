"""Operators that prepare text and vectors for training; nothing else imports them."""
