"""Column expressions: casts, row hashes and change predicates."""

from tidemark.functions.casts import (  # noqa: F401
    blank_cast, canonical_text, cast_columns, flag_bool, guarded_date,
    guarded_number, ordinal_label, rename_columns, round_half_even_cast,
    rounded_text,
    with_missing_columns,
)
from tidemark.functions.hashing import row_hash  # noqa: F401
from tidemark.functions.predicates import (  # noqa: F401
    any_distinct, any_guarded_change, keep_old_if_null, normalised_text,
)
