"""Operators for preparing large language-model training corpora.

Nothing outside this folder imports it; removing the folder leaves the rest of the engine intact.
"""
