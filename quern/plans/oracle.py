"""The core queries' DuckDB statements."""

from quern.plans import queries  # noqa: F401
from quern.plans.registry import SQL  # noqa: F401
