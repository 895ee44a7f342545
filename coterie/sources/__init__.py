from .lines import betweenness_lines, community_lines, write_communities, write_scores
from .ratings import read_ratings
from .tables import co_active_hours, customer_parts

__all__ = [
    "betweenness_lines", "co_active_hours", "community_lines", "customer_parts", "read_ratings",
    "write_communities", "write_scores",
]
