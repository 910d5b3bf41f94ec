"""Operators that prepare training corpora for language models.

Nothing outside this folder imports it; ``registry`` lists its queries.
"""
