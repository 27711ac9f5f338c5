"""Sources and sinks: crawled CSV folders, typed tables, test inputs."""
