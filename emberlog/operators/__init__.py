"""Table operators: cleaning, filtering, aggregating, ranking, rolling counts and alert rules."""
