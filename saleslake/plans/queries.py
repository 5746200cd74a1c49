"""All registered queries (importing the modules registers them)."""

from __future__ import annotations

from saleslake.plans import q_rls  # noqa: F401
from saleslake.plans import q_clean  # noqa: F401
from saleslake.plans import q_load  # noqa: F401
from saleslake.plans import q_misc  # noqa: F401
from saleslake.plans import q_quality  # noqa: F401
from saleslake.plans import q_stream  # noqa: F401
from saleslake.plans.registry import ORACLE, QUERIES  # noqa: F401
