"""Operators for preparing language-model training data.

Nothing outside this folder imports it; ``__spark_entry__.py`` adds its
queries only when it is present.
"""
