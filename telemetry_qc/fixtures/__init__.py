"""What stands in for devices and failing stores in the registered queries."""
