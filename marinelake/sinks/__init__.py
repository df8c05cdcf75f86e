"""Parquet, GeoParquet, metadata and telemetry outputs."""
