"""Operators for training-data pipelines over text, web pages and vectors.

Each module holds one operator with an interface of its own; ``queries`` applies them to the test tables. Nothing else in
the library imports this package.
"""
