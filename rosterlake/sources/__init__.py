"""Readers and writers: landed reports, entities, uploaded CSV files, stored tables, outbox."""
