"""Values that a Python worker makes once, though its functions come anew with every task."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

from ..session import ship_by_value

ship_by_value(__name__)


def once(name: str, make: Callable[[], object]) -> object:
    """What ``make`` returned when ``name`` was first asked for in this process.

    Functions travel to the workers by value, their globals too, so neither a global nor a cache
    object would last: the former is new in every task, the latter is sent by the name of a module
    that the worker need not have. Values are kept in an empty module of the process instead.
    """
    home = sys.modules.setdefault("_kept_by_task_functions", types.ModuleType("_kept_by_task_functions"))
    if name not in home.__dict__:
        home.__dict__[name] = make()
    return home.__dict__[name]
