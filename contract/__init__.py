"""The driver's tables seen as rental data, the registered queries and their SQL oracles."""
