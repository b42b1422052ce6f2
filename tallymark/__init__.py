"""Payment-settlement reconciliation as Spark DataFrame operators."""
