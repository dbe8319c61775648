"""Operators for large training corpora. Nothing outside this folder imports it, but for the guarded import of the entry file."""
