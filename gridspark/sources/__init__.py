"""Named tables, typed reads over them, and file formats."""
