"""Registered queries and their SQL counterparts."""

from . import marts, basics, orders, events, reviews, algorithms, streams  # noqa: F401
from .base import QUERIES, SQL  # noqa: F401
