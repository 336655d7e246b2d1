"""Operators for preparing training data: formatting, tokenisation, scans and deduplication.

Nothing else in the package imports this subpackage.
"""
