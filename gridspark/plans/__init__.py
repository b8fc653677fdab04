"""Layout helpers shared by the operators: skew splitting, positions, halos, exact quantiles."""

from gridspark.plans.quantiles import exact_quantiles, wide_quantiles
from gridspark.plans.skew import (
    CHUNK,
    attach,
    carried_chunks,
    halo_blocks,
    hot_groups,
    is_split,
    keyed,
    largest_group,
    positions,
    sized,
    split_hot,
    unkeyed,
    unsized,
)

__all__ = [
    "CHUNK",
    "attach",
    "carried_chunks",
    "exact_quantiles",
    "halo_blocks",
    "hot_groups",
    "is_split",
    "keyed",
    "largest_group",
    "positions",
    "sized",
    "split_hot",
    "unkeyed",
    "unsized",
    "wide_quantiles",
]
