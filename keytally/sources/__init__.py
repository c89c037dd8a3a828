"""Sources and sinks: record logs, tables, JDBC and Kafka option builders."""
