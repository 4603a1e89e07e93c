"""Where rows come from and go to: topics, JSONL files, stored pages, bundled test tables."""
