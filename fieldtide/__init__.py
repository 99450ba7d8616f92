"""fieldtide: Spark DataFrame operators for field-service and supply-chain analytics."""
