"""Stand-in views, registered queries and their SQL twins."""
