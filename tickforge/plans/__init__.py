"""Ingestion, storage and the ledger; bars and features of a warehouse."""
