"""Registered queries and the SQL that each is compared with."""

from tickspark.plans import composed, features, live, market, models, operations, sessions  # noqa: F401
from tickspark.plans.common import ORACLES, QUERIES  # noqa: F401
