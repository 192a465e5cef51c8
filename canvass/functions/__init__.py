from canvass.functions.exprs import (  # noqa: F401
    is_finite,
    is_national,
    json_number,
    n_unique,
    nan_to_zero,
    pearson,
    pct_guarded,
    ratio,
    sum0,
)
