"""Workbooks and the data source that reads them in byte ranges."""
