"""Readers. Event readers deliver the schema ``trolley.schemas.EVENT``."""
