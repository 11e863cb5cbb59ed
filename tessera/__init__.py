"""Spark-native entity-link resolution.

Functions of this package that run on executors are sent by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Names of the package, by the module that has them: loaded when asked for, so that a part of the package is imported alone.
_EXPORTS = {"Config": "tessera.config", "Counts": "tessera.plans.bulk", "Engine": "tessera.plans.bulk"}
__all__ = list(_EXPORTS)


def __getattr__(name: str):
    from importlib import import_module

    if name not in _EXPORTS:
        raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
    return getattr(import_module(_EXPORTS[name]), name)
