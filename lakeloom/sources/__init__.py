"""Scans, batch discovery, writers and versioned snapshots of tables."""
