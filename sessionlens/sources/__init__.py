"""Sources and sinks: session views, typed readers and writers."""
