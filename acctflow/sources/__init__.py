"""Sources and sinks: file I/O, inline rows, views, SQL, and the test-data map."""
