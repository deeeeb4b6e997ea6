"""Changes to tables: upserts, replacements, merges, pruning, repair."""
