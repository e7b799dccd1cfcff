from eventmart.functions.expressions import (  # noqa: F401
    CATEGORY_LABELS,
    category_label,
    first_truthy,
    round2,
    to_double,
)
