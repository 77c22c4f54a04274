"""Operators for text corpora that are to train language models. Nothing else in the library imports this."""
