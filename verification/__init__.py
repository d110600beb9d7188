"""The registered queries over the supplied tables, and their equivalents in plain SQL."""
