"""Operators of a training-data pipeline over documents, embeddings and labels.

Nothing else in the library imports this package; ``catalog`` registers its
queries.  See the README's section on these operators for the design.
"""
