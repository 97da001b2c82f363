from .load import LoadResult, TargetNotEmpty, bucketed, load_table, open_target, read_target, remove_replaced, stage
from .restrict import (
    RestrictionList,
    anti_join,
    anti_join_bucketed,
    flag_restricted,
    only_restricted,
    prepare_list,
    restriction_keys,
)
from .watermark import Watermark, count_new, footer_marks, newer_than, read_watermark, resolve_watermark

__all__ = [
    "LoadResult", "RestrictionList", "TargetNotEmpty", "Watermark", "anti_join", "anti_join_bucketed",
    "bucketed", "count_new", "flag_restricted", "footer_marks", "load_table", "newer_than", "only_restricted", "open_target", "prepare_list",
    "read_target", "read_watermark", "remove_replaced", "resolve_watermark", "restriction_keys", "stage",
]
