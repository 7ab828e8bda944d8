"""Every operator as a query over the driver tables, with its oracle SQL."""

import importlib
import pkgutil

from sumweave.queries.base import ORACLE, QUERIES

for _module in sorted(m.name for m in pkgutil.iter_modules(__path__)):
    importlib.import_module(f"{__name__}.{_module}")

__all__ = ["ORACLE", "QUERIES"]
