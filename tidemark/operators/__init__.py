"""DataFrame-to-DataFrame operators: coercion, loads, history, checks, profiles."""
