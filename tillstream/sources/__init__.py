"""Reading and writing: lake, topics, warehouse tables, the benchmark tables."""
