"""Spark-native workbook analytics: worksheets as tables.

``register(spark)`` adds the data source ``gridscan`` and the SQL table function ``read_sheet``.
"""

from __future__ import annotations

__version__ = "0.1.0"


def register(spark) -> None:
    """Make both forms of the scan known to a session; may be called again."""
    from .functions.read_sheet import read_sheet
    from .sources.sheet import SheetSource

    spark.dataSource.register(SheetSource)
    spark.udtf.register("read_sheet", read_sheet)
