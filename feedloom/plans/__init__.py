"""Operators put together: candidates of a run, digests of many runs."""
