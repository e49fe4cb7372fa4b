"""Source pipelines, the entity-by-period panel and the star schema, as compositions of operators."""
