"""Plan-shaping helpers: lineage cuts and dense indexing."""

from .batches import small_batches
from .checkpoint import checkpoint_dir, cut_lineage, release, scratch_path, write_through
from .indexing import dense_index

__all__ = ["checkpoint_dir", "cut_lineage", "release", "scratch_path", "write_through", "dense_index", "small_batches"]
