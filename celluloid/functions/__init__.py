"""Column functions: parse rules, text matching, IRIs and variant access."""
