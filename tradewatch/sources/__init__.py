"""Sources: driver-table binding, CSV / text / table readers."""
