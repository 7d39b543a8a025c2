"""Writers, keyed tables and schema contracts."""
