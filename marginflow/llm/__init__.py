"""Operators for preparing text corpora (see README, "Corpus operators")."""
