"""lakeops: everyday tabular data work expressed as Spark DataFrame plans.

Sub-packages
------------
sources    readers and writers (CSV, text, Parquet, literal rows, file inventory)
functions  Column-expression helpers (null-safe predicates, casts, text, sizing)
operators  DataFrame -> DataFrame transforms (cleaning, text, row-level ops, layout)
plans      versioned Parquet datasets, change feed, composite jobs
streaming  Structured Streaming jobs (line streams, change streams)
"""

from lakeops.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir", "VersionedDataset", "DatasetBuilder", "Catalog"]

_LAZY = {
    "VersionedDataset": "lakeops.plans.versioned",
    "DatasetBuilder": "lakeops.plans.versioned",
    "Catalog": "lakeops.plans.catalog",
}


def __getattr__(name):  # loaded on first use: no import cycle, no cost for plain imports
    if name in _LAZY:
        import importlib

        return getattr(importlib.import_module(_LAZY[name]), name)
    raise AttributeError(name)
