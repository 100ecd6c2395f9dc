"""Analytics over high-frequency event and market series, declared as Spark plans."""
