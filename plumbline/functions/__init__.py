from plumbline.functions.scalars import (
    key_digest,
    null_default,
    percent_of_total,
    positive_probability,
    sign_colour,
    sortable_score,
    split_bucket,
    tie_number,
)

__all__ = [
    "key_digest",
    "null_default",
    "percent_of_total",
    "positive_probability",
    "sign_colour",
    "sortable_score",
    "split_bucket",
    "tie_number",
]
