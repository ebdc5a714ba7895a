"""File sources, warehouse tables and exports."""
