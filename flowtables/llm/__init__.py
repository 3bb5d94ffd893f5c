"""Operators for training data: ten of them, their queries, and a pipeline over them."""
