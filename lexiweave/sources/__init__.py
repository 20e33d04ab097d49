from .libsvm import read_libsvm, write_libsvm
from .postings import read_postings, write_postings
from .reports import (
    read_cluster_members,
    read_graph_edges,
    read_graph_nodes,
    read_membership,
    write_cluster_members,
    write_graph,
    write_membership,
    write_tag_counts,
)
from .resume import finished_groups, pending_files, read_pending_lines
from .text import (
    read_category_lines,
    read_grouped_lines,
    read_lines,
    read_weighted_lines,
    read_weighted_terms,
)

__all__ = [
    "finished_groups",
    "pending_files",
    "read_category_lines",
    "read_cluster_members",
    "read_graph_edges",
    "read_graph_nodes",
    "read_grouped_lines",
    "read_libsvm",
    "read_lines",
    "read_membership",
    "read_pending_lines",
    "read_postings",
    "read_weighted_lines",
    "read_weighted_terms",
    "write_cluster_members",
    "write_graph",
    "write_libsvm",
    "write_membership",
    "write_postings",
    "write_tag_counts",
]
