"""Named reports over the star-schema tables and the layered flow."""
