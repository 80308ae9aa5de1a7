"""Where records come from: topics, JSON payloads, stored tables, JDBC."""
