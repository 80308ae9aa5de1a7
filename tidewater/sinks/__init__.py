"""Where records go: topics, tables written once per batch, JDBC."""
