"""All registered queries and their SQL twins."""

from ledgerlens.plans.queries import cleansing, fraud, lake, modelling, reports  # noqa: F401
from ledgerlens.plans.queries.base import ORACLES, QUERIES  # noqa: F401
