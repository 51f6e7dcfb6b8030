"""The registered queries: input mapping, Spark plan and SQL check for each."""
