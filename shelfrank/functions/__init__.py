from shelfrank.functions.columns import (  # noqa: F401
    MS_THRESHOLD,
    RANK_DIGITS,
    as_col,
    cosine,
    dot,
    epoch_seconds,
    half_star,
    java_string_hash,
    java_trim,
    l2norm,
    pack_entry,
    rank_key,
    unpack_entry,
    year_month,
)
