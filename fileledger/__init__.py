"""Archives, ledgers and signals as Spark tables."""
