"""Incremental, restriction-filtered, audited table loads on Spark."""

from .functions import conform, declared_type, normalise_key, scrub_delims, table_of_file
from .operators import *  # noqa: F401,F403
from .operators import __all__ as _operators
from .plans import *  # noqa: F401,F403
from .plans import __all__ as _plans
from .session import local_session
from .sources import *  # noqa: F401,F403
from .sources import __all__ as _sources

__all__ = [
    *_operators, *_plans, *_sources,
    "conform", "declared_type", "local_session", "normalise_key", "scrub_delims", "table_of_file",
]
