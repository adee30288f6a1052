"""Sources and sinks: driver tables, derived panels, file IO, dimension tables."""
