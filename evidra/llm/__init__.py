"""Operators for preparing language-model training data.

Nothing outside this subpackage imports it.  ``evidra.llm.registry`` lists its queries.
"""
