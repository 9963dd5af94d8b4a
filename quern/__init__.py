"""quern: incremental record synchronisation and text analytics on PySpark DataFrames."""
