"""Relational building blocks shared by the plans."""

from leadflow.operators.dedupe import best_per_key
from leadflow.operators.joins import (coalesced_key_join, left_join_left_pred,
                                      match_merge, positional_merge, semi_join)
from leadflow.operators.keys import blank_key, broadcast_small, text_key
from leadflow.operators.lookups import (earliest_balance, history_pivot,
                                        status_codes)
from leadflow.operators.carry import sticky_flag
from leadflow.operators.ordering import input_order, number_rows
from leadflow.operators.stage import stage

__all__ = ["best_per_key", "coalesced_key_join", "left_join_left_pred",
           "match_merge", "semi_join", "earliest_balance", "history_pivot",
           "status_codes", "sticky_flag", "stage", "positional_merge",
           "blank_key", "broadcast_small", "text_key", "input_order", "number_rows"]
