"""The models (silver, facts, staging, dims, snapshots, KPI views) as
functions ``model(inputs, params) -> DataFrame``, and the incremental build."""
