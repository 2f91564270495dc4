"""voxmill: Spark jobs that turn pages of customer feedback into searchable, scored records."""
