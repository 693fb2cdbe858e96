"""Reading and writing topics, tables and streaming state."""
