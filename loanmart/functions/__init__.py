from loanmart.functions.scalars import (  # noqa: F401
    cap,
    drop_sentinel,
    earliest_expr,
    flag,
    hash_int,
    hash_unit,
    latest_expr,
    map_values,
    nan_to_null,
    null_if,
    r6,
    replace_value,
    safe_div,
)
