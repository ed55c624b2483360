"""Subpackage of weftline."""
