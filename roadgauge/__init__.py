"""Vehicle telemetry and parcel delivery analytics as Spark DataFrame and streaming jobs."""
