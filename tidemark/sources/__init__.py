"""Tables on storage: CSV files, feature snapshots and ledgers."""
