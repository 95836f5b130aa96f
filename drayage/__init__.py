"""Bulk object transfer as Spark jobs: inventory, chunk plans, balanced assignment, copying and accounting."""

from .facade import plan_transfer
from .operators import *  # noqa: F401,F403
from .operators import __all__ as _operators
from .plans import *  # noqa: F401,F403
from .plans import __all__ as _plans
from .settings import effective_chunk_size
from .sources import *  # noqa: F401,F403
from .sources import __all__ as _sources
from .streaming import *  # noqa: F401,F403
from .streaming import __all__ as _streaming

__all__ = ["effective_chunk_size", "plan_transfer", *_operators, *_plans, *_sources, *_streaming]
