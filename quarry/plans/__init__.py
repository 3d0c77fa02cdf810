"""The query catalogue over the driver tables.

Importing this package registers every query module; ``QUERIES`` and
``ORACLE`` are then complete.
"""

from quarry.plans import q_colour, q_forms, q_iterative, q_models, q_reports, q_stats, q_stores, q_streams, q_text, q_warehouse, q_weather  # noqa: F401
from quarry.plans.registry import ORACLE, QUERIES  # noqa: F401
