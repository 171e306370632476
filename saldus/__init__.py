"""saldus: a PySpark-native ledger reconciliation engine."""
