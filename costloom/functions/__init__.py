from costloom.functions.missing import (  # noqa: F401
    clamp01,
    div_guarded,
    div_ieee,
    drop_null_keys,
    fill_zero,
    finite,
    greatest_first,
    holds,
    inf_to_null,
    inf_to_null_all,
    nan_to_null,
    positive_or_null,
    sum0,
    total0,
)
