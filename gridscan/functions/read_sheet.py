"""The SQL table function ``read_sheet(path, option => value, ...)``.

It is one task and the convenient form; the data source, which ``CREATE VIEW ... USING gridscan`` names in SQL, reads the same in parallel.
"""

from __future__ import annotations

from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, udtf

from ..operators import options as opts
from ..sources.sheet import Scan, batches, bind


def _scan(path, given: dict) -> Scan:
    return bind(opts.parse({"path": path, **given}))


class ReadSheet:
    @staticmethod
    def analyze(path: AnalyzeArgument, **given: AnalyzeArgument) -> AnalyzeResult:
        return AnalyzeResult(_scan(path.value, {k: v.value for k, v in given.items()}).spark_schema())

    def eval(self, path: str, **given):
        scan = _scan(path, given)
        for batch in batches(scan, 0, max(1, scan.sheet.size)):
            yield from zip(*(c.to_pylist() for c in batch.columns))


read_sheet = udtf(ReadSheet, useArrow=True)
