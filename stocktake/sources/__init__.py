"""Sources: timelines, JSON documents, clip inventories, archives, logs. All keep an explicit order of rows."""
