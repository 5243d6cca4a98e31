"""Data-quality checks, their fused measurements, and the blocking gate."""
