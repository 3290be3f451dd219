"""Query plans: lake assembly, registered queries and their SQL oracles."""
