"""Operators for preparing large training corpora.

Nothing else in the package imports this subpackage; its queries are
registered by the driver entry point when it is present.
"""
