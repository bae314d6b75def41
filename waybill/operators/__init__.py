"""DataFrame operators: picks, merges, quality rules, key links, roll-ups and reshaping."""
