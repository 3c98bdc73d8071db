"""Incremental refresh of the panel from a landing folder of new events."""
