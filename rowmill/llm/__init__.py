"""Operators for preparing training data: thirteen document, page and vector operators and their queries.

Nothing else in the library imports this subpackage. Every operator takes and returns DataFrames; the
query of the same number in `queries` derives its report from the operator's result.
"""
