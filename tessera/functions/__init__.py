from .scalar import (apply_threshold, clean_name, collapse_values, cut, derive, extract,
                     flag_equals, inv_log_target, log_target, map_values, minmax_score,
                     nonfinite_to_null, presence_flag, round_half_even)

__all__ = ["apply_threshold", "clean_name", "collapse_values", "cut", "derive", "extract",
           "flag_equals", "inv_log_target", "log_target", "map_values", "minmax_score",
           "nonfinite_to_null", "presence_flag", "round_half_even"]
