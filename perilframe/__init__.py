"""perilframe: hazard footprints and loss-record matching as DataFrame functions on PySpark."""
