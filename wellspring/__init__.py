"""Read, barcode, interval and expression analytics on PySpark DataFrames."""
