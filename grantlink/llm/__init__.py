"""Operators for building training corpora at scale; nothing else in the package imports them."""
