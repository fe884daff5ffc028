"""Queries over scans, their SQL counterparts and the workbooks that they read."""
