"""Set-based sync operators: the four folds and their helpers."""

from tidemark.operators.backfill import backfill  # noqa: F401
from tidemark.operators.common import FoldResult, history_schema  # noqa: F401
from tidemark.operators.dedupe import first_per_key  # noqa: F401
from tidemark.operators.guards import (  # noqa: F401
    ConstraintViolation, assert_no_batch_duplicates, assert_not_null,
    assert_unique, key_violations,
)
from tidemark.operators.ids import assign_ids  # noqa: F401
from tidemark.operators.keyed_upsert import keyed_upsert  # noqa: F401
from tidemark.operators.lookup import lookup_join  # noqa: F401
from tidemark.operators.scd1 import scd1_fold  # noqa: F401
from tidemark.operators.scd2 import scd2_fold  # noqa: F401
from tidemark.operators.version_set import version_set_fold  # noqa: F401
