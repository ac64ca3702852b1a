"""Input schemas, table access, CSV and model-folder locations."""
