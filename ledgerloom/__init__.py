"""ledgerloom: share-of-wallet, cash-cycle and filing analytics on Spark DataFrames."""
