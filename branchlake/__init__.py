"""branchlake: incremental multi-branch lake loading and reconciliation on Spark."""
