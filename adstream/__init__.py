"""Ad-event analytics on Spark: match, validate, enrich and store ad beacons."""
