"""Flight-itinerary analytics as Spark DataFrame operators."""
