"""Sources and sinks: driver tables, stand-in relations, drop folders, CSV."""
