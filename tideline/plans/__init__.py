"""The registered queries: each operator on the given tables, with an independent SQL form."""

from __future__ import annotations

from tideline.plans import cars, keyed, rides, windows, words  # noqa: F401
from tideline.plans import streams  # noqa: F401, I001  (reuses the SQL of the others)
from tideline.plans.registry import QUERIES, SQL  # noqa: F401
