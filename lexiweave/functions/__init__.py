from .fields import (
    class_flag,
    contains_both,
    contains_term,
    drop_empty,
    extract_field,
    parse_group_id,
    profile_tag_array,
    split_values,
)
from .text import blank_split, words
from .thresholds import graph_theta, index_theta, min_part_size

__all__ = [
    "blank_split",
    "class_flag",
    "contains_both",
    "contains_term",
    "drop_empty",
    "extract_field",
    "graph_theta",
    "index_theta",
    "min_part_size",
    "parse_group_id",
    "profile_tag_array",
    "split_values",
    "words",
]
