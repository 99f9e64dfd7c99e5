"""Input schemas, adapter views over the driver tables, and input loading."""
