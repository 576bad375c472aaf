"""Operators for training-data pipelines over documents and embeddings.

Nothing else in the library imports this subpackage. Each module holds one
operator; ``queries`` registers them for the driver.
"""
