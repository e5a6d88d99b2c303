"""Layer runs and step lists built from declarative specs, and the registered queries."""
