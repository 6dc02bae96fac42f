"""Jobs, table bindings, registered queries and their SQL oracles."""
