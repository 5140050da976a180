"""Evaluate a value once for use inside higher-order-function lambdas.

An outer expression referenced inside a ``transform``/``aggregate`` lambda is
evaluated again for every element, so a per-array value (its maximum, its
encoded bytes) used in a lambda costs O(n) per element. ``let`` evaluates the
bindings once into a one-element array of structs and passes the struct to the
body as a lambda variable, whose field accesses are cheap.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(body: Callable[[Column], Column], **bindings: Column) -> Column:
    """``body(s)`` where ``s["name"]`` is each binding evaluated once."""
    s = F.struct(*[c.alias(k) for k, c in bindings.items()])
    return F.get(F.transform(F.array(s), body), 0)
