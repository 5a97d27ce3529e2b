"""Domain views over the star-schema test tables, the registered queries and their SQL."""
