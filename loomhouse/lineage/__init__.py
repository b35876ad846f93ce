"""Column-lineage documents, graph tables, closures, audits and reviews."""
