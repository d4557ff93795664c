"""Analytics over DataFrames: every function is a lazy plan unless it says so."""
