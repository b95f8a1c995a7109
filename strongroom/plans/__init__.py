"""Snapshot (spine, PIT, bridge) and information-mart builds."""
