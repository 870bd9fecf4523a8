"""Relational operators: splits, ordinals, pairing, n-grams, metrics, SFT, captioner."""
