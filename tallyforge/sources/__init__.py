"""Table sources, driver-table re-aiming and document sinks."""

from .tables import DRIVER_TABLES, load, scan  # noqa: F401
