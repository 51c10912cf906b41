"""Query shapes shared by the operators: ordered slices, hash cuts, lineage cuts."""
