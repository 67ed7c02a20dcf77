"""Table catalog, readers, raw landing store and the star-schema adapter."""
