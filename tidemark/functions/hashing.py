"""Row hashes for change detection.

``md5`` over the ``|``-joined text of a column list, NULL as the empty
string.  One generic expression replaces one hand-written function per
table; the per-table column lists live in ``tidemark.plans.entities``.

Neighbouring doubles are turned into text as one array (``transform``), so
that the text of a double stands in the plan once per run of them.  Written
out per column, a hash over a dozen doubles is a generated method beyond
what the runtime compiles, and every row is interpreted.
"""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.casts import canonical_text

SEPARATOR = "|"


def _resolve(schema: T.StructType, item, as_double: bool):
    if isinstance(item, tuple):
        col, dtype = item
    else:
        dtype = schema[item].dataType
        col = F.col(f"`{item}`")
    if as_double and not isinstance(dtype, (T.StringType, T.DoubleType)):
        # The hash functions of the season tables take every stat as a
        # double, so an integer column and its double twin hash alike.
        col, dtype = col.cast("double"), T.DoubleType()
    return col, dtype


def _is_double(part) -> bool:
    return isinstance(part[1], (T.FloatType, T.DoubleType))


def row_hash(schema: T.StructType, items, as_double: bool = False) -> Column:
    """md5 of ``coalesce(text(c1),'') || '|' || ...``.

    ``items`` are column names (type read from ``schema``) or
    ``(Column, DataType)`` pairs for computed parts such as constants.
    """
    texts = []
    for doubles, run in groupby((_resolve(schema, it, as_double) for it in items), _is_double):
        if doubles:
            values = F.array(*[c.cast("double") for c, _ in run])
            texts.append(F.transform(values, lambda x: F.coalesce(
                canonical_text(x, T.DoubleType()), F.lit(""))))
        else:
            texts += [F.coalesce(canonical_text(c, t), F.lit("")) for c, t in run]
    return F.md5(F.concat_ws(SEPARATOR, *texts))
