"""Where rows come from: topics, replayed topic dumps, the changelog store."""
