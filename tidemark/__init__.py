"""Event analytics on PySpark: rules over event, error, purchase and entitlement tables."""
