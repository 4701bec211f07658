"""The driver's tables cast in the roles of trips, zones, reports and texts."""
