"""Writers of snapshots, tables and the daily fact."""
