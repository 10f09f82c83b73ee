"""Environment x health analytics on Spark: DataFrame -> DataFrame, lake I/O at the edges."""
