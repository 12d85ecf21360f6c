"""Query plans over the driver's tables: stand-in mappings, the query
registry and the equivalent oracle SQL."""
