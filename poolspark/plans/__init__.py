"""Plan helpers: materialisation on shared storage and stage pipelines."""
