"""recheck: data reconciliation and validation on Spark (see README.md)."""
