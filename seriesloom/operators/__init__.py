"""DataFrame-to-DataFrame operators on panels."""
