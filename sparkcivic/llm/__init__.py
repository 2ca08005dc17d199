"""Operators for preparing text corpora for language-model training.

One module per operator. Nothing else in the package imports this one.
"""
