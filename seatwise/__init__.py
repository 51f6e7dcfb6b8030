"""Usage and access analytics over daily activity files and identity snapshots."""
