"""Operators for preparing large text corpora.

Nothing else in the library imports this subpackage; its queries are in
:mod:`tidewater.llm.queries`.
"""
