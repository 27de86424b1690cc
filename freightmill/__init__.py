"""Supply-chain and fleet analytics as Spark DataFrame plans."""
