"""Registered queries on the driver's tables, each with its SQL counterpart where SQL can express it."""

from tidemark.plans import evaluation, files, logs, models, profiles, streams, tables  # noqa: F401
from tidemark.plans.registry import ORACLES, QUERIES  # noqa: F401
