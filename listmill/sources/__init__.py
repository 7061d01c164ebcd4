"""Where rows come from and go to: logs, offset state, bronze and silver tables."""
