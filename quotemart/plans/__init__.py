"""The warehouse tables as declarative plans, and the two jobs that load them."""
