"""Registered queries over the driver's tables."""

from lociq.plans import records as records  # registers its queries
from lociq.plans.catalog import ORACLES as ORACLES
from lociq.plans.catalog import QUERIES as QUERIES
