"""Training-data operators: tokenising, de-duplication, filtering, formatting and output of text corpora.

Nothing else in the package imports this subpackage. ``queries`` registers one query per operator.
"""
