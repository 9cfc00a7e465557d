"""Document-record analytics on PySpark: DataFrame-to-DataFrame operators for notices, records and their history."""
