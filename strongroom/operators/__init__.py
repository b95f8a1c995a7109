"""Vault loaders, profiling checks and audits."""
