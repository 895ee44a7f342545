"""Who-shares-what graphs on Spark: co-affiliation, betweenness and communities."""

from .operators.components import community_members, connected_components
from .operators.divisive import best_communities, cut_curve, edges_after, removal_order
from .operators.edges import (
    adjacency, affiliation_sets, affiliations, coaffiliation_edges, degrees, graph_size, simple_edges, symmetrize,
    vertices,
)
from .operators.modularity import modularity
from .operators.paths import (
    bfs_levels, edge_betweenness, reachable, shortest_path_counts, source_edge_credit,
)
from .operators.structural import similar_edges, structural_components, structural_similarity
from .plans.scratch import clear_results, release
from .sources import (
    betweenness_lines, co_active_hours, community_lines, customer_parts, read_ratings,
    write_communities, write_scores,
)

__all__ = [
    "adjacency", "affiliation_sets", "affiliations", "best_communities", "betweenness_lines",
    "bfs_levels", "clear_results", "co_active_hours", "coaffiliation_edges", "community_lines", "community_members",
    "connected_components", "customer_parts", "cut_curve", "degrees", "edge_betweenness",
    "edges_after", "graph_size", "modularity", "reachable", "read_ratings", "release", "removal_order",
    "shortest_path_counts", "similar_edges", "simple_edges", "source_edge_credit", "structural_components",
    "structural_similarity", "symmetrize", "vertices", "write_communities", "write_scores",
]
