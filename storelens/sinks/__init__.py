"""Writing tables: layouts, reloads, upserts, saved subsets and summaries."""
