"""All core queries: importing the plan modules registers them."""

from quern.plans import checked, counts, dedups, joined, known, lexical, packed, profiles, roundtrip, scored, sourced, taught, texts  # noqa: F401
from quern.plans.registry import Q  # noqa: F401
