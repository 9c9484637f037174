"""Whole flows, and the query catalogue with its SQL counterparts."""
