"""The retail tables as views over the driver's test data, with the checks run on them."""
