"""Training-data corpus operators on Spark. Nothing else in the library imports this subpackage."""
