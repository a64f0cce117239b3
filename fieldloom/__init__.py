"""fieldloom: a Spark-first analytics engine for tiled imagery, label polygons and patch vectors."""
