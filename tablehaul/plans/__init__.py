"""What to read and how: profiles, key ranges, catalogs, strategies."""
