"""Operators for preparing training corpora.

Self-contained: nothing outside this folder imports it, and deleting the
folder leaves the rest of the library working.
"""
