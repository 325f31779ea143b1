"""Operators for text and vectors of training data. Nothing outside this subpackage imports it."""
