"""Named queries over the sample tables, each next to its SQL twin, and the end-to-end jobs."""
