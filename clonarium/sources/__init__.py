"""Reading cohort files and writing the canonical store."""
