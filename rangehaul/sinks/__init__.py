"""Snapshot writes, staging, publication and the run ledger."""
