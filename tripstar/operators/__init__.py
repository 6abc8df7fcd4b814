"""DataFrame -> DataFrame steps: cleaning, star schema, profile, extensions."""
