from clearbrook.functions.clamps import clamp_null_to_high, clamp_positive, clip, outside
from clearbrook.functions.labels import map_labels, map_labels_by_table, map_labels_or_default
from clearbrook.functions.scalars import (
    blank_to_null,
    composite_key,
    normalize_label,
    not_positive,
    off_domain,
    parse_date,
    relative_deviation,
    safe_double,
    safe_int,
)
