"""DataFrame transformations: fragments to persons, persons to curated records."""
