"""Table-level operators: DataFrame in, DataFrame out."""

from masterloom.operators.lookup import (
    Reference,
    attach,
    enrich_reference,
    fits_broadcast,
    frequent_keys,
    lookup_join,
    one_row_per_key,
)
from masterloom.operators.mapping import apply_mapping
from masterloom.operators.phones import check_foreign, normalize_phones, standardize_phones, with_dial_plan
from masterloom.operators.schema import (
    add_audit,
    conform,
    merged_schema,
    sanitize_columns,
    sanitized_names,
    schema_drift,
    string_schema,
    wider_type,
)
from masterloom.operators.spread import partitions_of, spread
from masterloom.operators.upsert import changed_keys, key_profile, reject_blank_keys, upsert, with_row_hash

__all__ = [
    "Reference",
    "add_audit",
    "apply_mapping",
    "attach",
    "changed_keys",
    "check_foreign",
    "conform",
    "enrich_reference",
    "fits_broadcast",
    "frequent_keys",
    "key_profile",
    "lookup_join",
    "merged_schema",
    "normalize_phones",
    "one_row_per_key",
    "partitions_of",
    "reject_blank_keys",
    "sanitize_columns",
    "sanitized_names",
    "schema_drift",
    "spread",
    "standardize_phones",
    "string_schema",
    "upsert",
    "wider_type",
    "with_dial_plan",
    "with_row_hash",
]
