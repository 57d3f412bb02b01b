"""Operators for preparing training text: each module holds one operator, ``queries`` registers them.

Nothing outside this package imports it; ``corpus_pipeline.py`` at the top of the repository strings five of them
together.
"""
