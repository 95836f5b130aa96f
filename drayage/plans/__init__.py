from .chunking import classify_transfer, plan_errors, plan_parts
from .grid import grid_assign, grid_slice, split_rebase
from .indexing import build_plan, unique_objects

__all__ = ["build_plan", "classify_transfer", "grid_assign", "grid_slice", "plan_errors", "plan_parts", "split_rebase",
           "unique_objects"]
