"""Jobs that read, transform, check and write whole tables."""
