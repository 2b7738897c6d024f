from prodseq.functions.columns import (
    case_of,
    clamp_at_zero,
    nan_to_null,
    number,
    ratio,
    rim_size,
    rounded,
    strip,
)

__all__ = [
    "case_of",
    "clamp_at_zero",
    "nan_to_null",
    "number",
    "ratio",
    "rim_size",
    "rounded",
    "strip",
]
