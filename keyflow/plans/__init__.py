"""Query plans: the table mapping, registered queries, oracles, composite jobs."""
