"""DataFrame operators: gates, keyed mutations, search, triples, patterns and graph queries."""
