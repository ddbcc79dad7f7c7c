"""Change predicates and merge rules of the keyed upsert."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_distinct(new: str, old: str, columns) -> Column:
    """OR of ``old.c IS DISTINCT FROM new.c`` over ``columns``."""
    return reduce(or_, [~F.col(f"{old}.`{c}`").eqNullSafe(F.col(f"{new}.`{c}`"))
                        for c in columns])


def any_guarded_change(new: str, old: str, columns) -> Column:
    """OR of ``new.c IS NOT NULL AND old.c IS DISTINCT FROM new.c``:
    a NULL in the batch never counts as a change."""
    return reduce(or_, [F.col(f"{new}.`{c}`").isNotNull()
                        & ~F.col(f"{old}.`{c}`").eqNullSafe(F.col(f"{new}.`{c}`"))
                        for c in columns])


def keep_old_if_null(new: str, old: str, column: str) -> Column:
    """``COALESCE(new.c, old.c)``."""
    return F.coalesce(F.col(f"{new}.`{column}`"), F.col(f"{old}.`{column}`"))


def normalised_text(c: Column) -> Column:
    """``upper(trim(x))``, used as an equi-join key."""
    return F.upper(F.trim(c))
