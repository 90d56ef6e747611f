"""Operators of a training-data pipeline over `documents`, `pages`, `embeddings` and `conversations`.

Nothing else in the library imports this subpackage; `registry` holds its queries and their SQL twins.
"""
