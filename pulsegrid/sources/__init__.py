"""Readers for landed statuses, delimited files, batch definitions and loaded tables."""
