"""tracklane: cleaning, aligning, merging and reporting of track-list data as Spark DataFrame jobs."""
