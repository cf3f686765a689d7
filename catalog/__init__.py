"""The registered queries and, for each, SQL that must give the same result."""
