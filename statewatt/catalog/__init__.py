"""Every operator and model as a query over the driver's tables, each with
the same question in plain SQL for an independent engine."""

from statewatt.catalog.registry import ORACLES, QUERIES
from statewatt.catalog import operators as _operators  # noqa: F401
from statewatt.catalog import joins as _joins  # noqa: F401
from statewatt.catalog import models as _models  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
