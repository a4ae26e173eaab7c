"""Named reports, lookups and document builders."""
