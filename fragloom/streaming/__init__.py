"""The incremental form: fragments in, persons out, and when to curate."""
