"""Operators for building training corpora, and the queries registered for them."""
