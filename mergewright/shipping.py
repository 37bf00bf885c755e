"""Python workers need no copy of this package: functions of registered modules travel by value."""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def by_value(module: str) -> None:
    cloudpickle.register_pickle_by_value(sys.modules[module])
