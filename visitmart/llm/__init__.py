"""Training-data pipeline operators. Nothing else in the library imports this
subpackage; its queries are registered through ``visitmart.llm.registry``."""
