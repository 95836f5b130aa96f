from .incremental import copy_new, incremental_copy, ledger
from .progress import cumulate, progress_ticks, run_progress_stream, running_copy, ticks

__all__ = ["copy_new", "cumulate", "incremental_copy", "ledger", "progress_ticks", "run_progress_stream",
           "running_copy", "ticks"]
