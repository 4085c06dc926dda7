"""DataFrame operators (each returns a lazily planned DataFrame)."""

from .joins import (  # noqa: F401
    anti, edge_both_ways, semi, substring_join, substring_keys, summary_star,
    token_join,
)
from .nested import (  # noqa: F401
    nested_objects, related_ids, section, to_document,
)
from .scoring import weighted_score, with_global_max  # noqa: F401
