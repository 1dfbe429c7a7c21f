"""Column functions on sequences. All are built of Spark's own expressions unless a name says otherwise."""
