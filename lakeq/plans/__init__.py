"""Query plans over the driver tables, their SQL oracles, and the staged run."""
