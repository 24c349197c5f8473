"""Every operator as a runnable query over the given tables, with its SQL twin."""

from carelens.registry import consistency, level1, level2, level3, native, snapshot  # noqa: F401
from carelens.registry.catalog import BUILDS, ORACLES
from carelens.registry.views import Data

__all__ = ["BUILDS", "ORACLES", "Data"]
