"""Plan-level helpers: lineage cuts, bounded broadcasts and interval binning."""
