"""Column-level standardisers, all native expressions."""

from masterloom.functions.codes import code_field, property_code, standardize_property_codes
from masterloom.functions.phones import (
    concat_phone_parts,
    dialled_number,
    formatted_number,
    last_digits,
    national_number,
    phone_part,
    strip_special,
)
from masterloom.functions.text import (
    blank_to_null,
    fill_blank,
    full_address,
    hhmm_time,
    initial_flag,
    reference_fallback,
)

__all__ = [
    "blank_to_null",
    "code_field",
    "concat_phone_parts",
    "dialled_number",
    "fill_blank",
    "formatted_number",
    "full_address",
    "hhmm_time",
    "initial_flag",
    "last_digits",
    "national_number",
    "phone_part",
    "property_code",
    "reference_fallback",
    "standardize_property_codes",
    "strip_special",
]
