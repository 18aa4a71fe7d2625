"""Product-review analytics on Spark: batch lake, change streams, silver schema and gold marts."""
