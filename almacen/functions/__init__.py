"""Column-level rules: every function takes and returns ``Column`` (JVM-side, codegen)."""

from almacen.functions.columns import (  # noqa: F401
    contains_map,
    date_key,
    flag_with_default,
    hash_pii,
    map_values,
    net_amount,
    normalise_text,
    positive_flag,
    rounded_ratio,
)
