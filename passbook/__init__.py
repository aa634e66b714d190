"""Change-data-capture analytics for a banking ledger, written as Spark jobs."""
