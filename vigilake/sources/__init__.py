"""Where rows come from: files, tables, Kafka."""
